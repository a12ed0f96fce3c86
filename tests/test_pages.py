from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.plans.pages import session_speakers
from lakemill.sources.pages import keywords, listed, speaker


def test_names_beside_a_heading():
    page = (
        "<ul><li>Before All</li></ul><h2>Les <i>candidats</i> déclarés</h2><p>x<ul><li>Not Beside</li></ul></p><ol><li><a>[1]</a> Ann Lee, mayor (left)</li><li><a href=/wiki/X>Bob Ray</a> and <a>Other</a>"
        "<ul><li>Inner One</li></ul></li><li>abc</li><li>Ann Lee</li></ol><div><ul><li>Deep One</li></ul></div><h3>Other</h3><ul><li>After All</li></ul><h4>En lice</h4><ul><li>Zed Zed</li></ul>"
    )
    assert listed(page) == [("[1] Ann Lee", False), ("Bob Ray", False), ("Ann Lee", False), ("Zed Zed", False)]


def test_links_are_guesses():
    page = "<h2>Candidats</h2><a href='/wiki/A_B'>Ann Lee</a><a href='/wiki/File:x'>Some File</a><a href='/x'>No Article</a><a href='/wiki/C'>Single</a><a href='/wiki/D'>A B</a><a href='/wiki/A'>Ann Lee</a>"
    assert listed(page) == [("Ann Lee", True)] and listed(None) == [] and listed("<ul><li") == []


def test_the_speaker_of_an_anchor():
    page = "<div class=perso><a href=/p>President</a></div><div class='intervention'><span id=a>x</span><div class='perso big'>Ann  Lee<br>deputy <a>no</a><a href=/ann>y</a></div></div><div id=b>no one</div>"
    assert speaker(page, "a") == ("Ann Lee deputy no y", "/ann") and speaker(page, None) == ("President", "/p") == speaker(page, "missing")
    assert speaker(page, "b") == (None, None) == speaker(None, "a")
    assert speaker("<div class=perso>" + "x" * 300 + "</div><div class=perso>Short</div>", None) == ("Short", None)


def test_keywords():
    assert keywords("<p class='nuage_de_tags'>mots-clés: Énergie, les; Climat. de cette</p>") == ["mots-clés", "Énergie", "Climat"]
    assert keywords("<p class=nuage_de_tags>" + " ".join(f"w{i}" for i in range(20))) == [f"w{i}" for i in range(8)] and keywords("<p>") == []


def test_deep_pages():
    assert speaker("<div>" * 5000 + "<div class=perso>Low</div>", None) == ("Low", None)


def test_pages_of_a_small_table_are_dealt_to_all_cores(spark):
    found = session_speakers(spark, "/root/testdata/sf0.001")
    assert found.groupBy(F.spark_partition_id()).count().count() == spark.sparkContext.defaultParallelism
