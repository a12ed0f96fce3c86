"""Exact deduplication by content-defined chunk recipes, with SQL functions only.

Texts are cut into chunks at places that their content chooses, so equal passages get equal chunks wherever they stand.
A cut depends on nothing but a hash of the last six characters, in every script. A chunk is named by its SHA-256
digest, and a dictionary that holds every distinct chunk once verifies the names: should one digest name two different
chunks, the documents that use it are named by longer digests. A document becomes the ordered list of its chunks' names,
its recipe, and documents are equal if their recipes are. A text that is not valid UTF-8 is cut as if its bad bytes were
U+FFFD, and its recipe ends with the digest of its own bytes, so only equal bytes are equal. A chunk's bytes move once for each map task that meets it;
documents move as recipes only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import cut, every_salt, salt_of, text_or_empty

#: Shortest and longest chunk in characters.
MIN_CHUNK, MAX_CHUNK = 512, 8192


def _some_bytes(factor: int, share: float = 0.36) -> str:
    """A character class of about such a share of the 256 byte values, dealt by a multiplicative hash."""
    return "[" + "".join(rf"\x{b:02x}" for b in range(256) if b * factor % 257 < 257 * share) + "]"


#: What ends a chunk between the two: each of the last six characters has a low byte in its own class. In UTF-16 the low
#: byte is what differs between the characters of a script. One place in 200 to 1,400 is such a place, as measured over
#: Latin, Cyrillic, Arabic, Devanagari, Chinese, Korean and Japanese signs.
#: The first half of a surrogate pair, the same for many signs, is passed over.
CUT = "".join(rf"(?:[^\xd8-\xdb]{_some_bytes(f)}|[\xd8-\xdb].)" for f in (167, 59, 101, 29, 211, 73))


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """Content-defined chunks of a text, in order; joined they give the text back. An empty text has none.

    The pattern runs over the text's UTF-16 bytes, one sign for each byte. No chunk ends inside a pair of surrogates.
    """
    pairs = F.decode(F.encode(text, "UTF-16BE"), "ISO-8859-1")
    whole = r"(?![\xdc-\xdf])"
    found = F.regexp_extract_all(pairs, F.lit(rf"(?s)((?:..){{{least - 6},{most - 6}}}?{CUT}{whole}|(?:..){{1,{most}}}{whole})"), F.lit(1))
    return F.transform(found, lambda x: F.decode(F.encode(x, "ISO-8859-1"), "UTF-16BE"))


def short_name(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def long_name(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 512))


def doubtful_names(rows: DataFrame, name: Callable[[Column], Column] = short_name) -> DataFrame:
    """Digests of rows(text) that name more than one chunk; empty as long as SHA-256 has no known collision.

    The pair of digest and chunk is the grouping key, so a chunk that a third of all documents hold leaves each map
    task once.
    """
    chunk = rows.select(F.explode(chunks(F.col("text"))).alias("chunk"))
    dictionary = chunk.select(name(F.col("chunk")).alias("name"), "chunk").distinct()
    return dictionary.groupBy("name").agg(F.count("*").alias("contents")).where("contents > 1").select("name")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: Callable[[Column], Column] = short_name) -> DataFrame:
    """Groups of equal texts: (doc_id, keep_id, group_size, kept, text_sha256, n_chunks), one row for each row of docs.

    Of equal texts the row with the largest id stays. Null texts count as empty, and all empty texts are one group. A
    null id is less than any other; a group of null ids only keeps null, and kept is true for its rows. Rows that
    repeat both id and text carry the same decision, since nothing tells them apart. An empty table gives an empty
    result; other columns of docs, whatever their names, are not read. Long texts need no more than their row. name
    gives a chunk's digest; a weak one costs time, as more names are in doubt, but no wrong group.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    doubtful = cut(doubtful_names(texts, name))
    # What the chunks of a text that is not valid UTF-8 cannot tell: its bytes.
    bad = F.when(~F.is_valid_utf8("text"), F.array(F.unhex(F.sha2("text", 256)))).otherwise(F.array().cast("array<binary>"))
    cut_up = texts.select("doc_id", F.sha2("text", 256).alias("text_sha256"), chunks(F.col("text")).alias("chunks"), bad.alias("bad"), salt_of("doc_id").alias("salt"))
    own = F.transform("chunks", name)
    if doubtful.isEmpty():
        named = cut_up.select("doc_id", "text_sha256", "salt", F.concat(own, "bad").alias("recipe"))
    else:
        # The documents that use such a name: dealt by name and salt, as a popular chunk has many occurrences.
        rows = cut_up.select("doc_id", "text_sha256", "salt", "bad", own.alias("short"), F.transform("chunks", long_name).alias("long"))
        used = rows.select("text_sha256", "salt", F.explode("short").alias("name"))
        renamed = used.join(doubtful.select("name", every_salt()), ["name", "salt"], "left_semi").select("text_sha256", "salt", F.lit(True).alias("renamed")).distinct()
        recipe = F.when(F.col("renamed"), F.col("long")).otherwise(F.col("short"))
        named = rows.join(renamed, ["text_sha256", "salt"], "left").select("doc_id", "text_sha256", "salt", F.concat(recipe, "bad").alias("recipe"))
    named = cut(named)
    groups = named.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    shared = groups.where("group_size > 1").select("recipe", "keep_id", "group_size", every_salt())
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return named.join(shared, ["recipe", "salt"], "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", F.size("recipe").cast("long").alias("n_chunks"),
    )
