"""The queries; importing the package registers them."""

from lakemill.plans import archives, assembled, audits, cohesion, debates, dims, documents, normalize, pages, rosters, storage, stores, templates, validators, views  # noqa: F401
