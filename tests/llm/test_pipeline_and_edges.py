"""Stages and edge cases: empty tables, nulls, planted cases, salvage, held-out accuracy."""

import gzip
import random
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerolag.llm import decontamination, oracles, pii, queries, stages
from aerolag.llm.caps import near_duplicate_vectors
from aerolag.llm.decontamination import contamination
from aerolag.llm.html import extract, main_texts
from aerolag.llm.language import identify_documents
from aerolag.llm.warc import Gap, archive_round_trip, salvage

from .cases import SCHEMA, documents

SMALL = "/root/testdata/sf0.01"


def test_redaction(spark):
    field = pii.fit([f"Write to user{i}@example.com now or call +1 555 010 {1000 + i} today." for i in range(60)])
    rows = [(1, "mail joe@example.com, 10.0.0.1."), (2, None), (3, ""), (4, "nothing here")]
    found = pii.redact(documents(spark, rows), field)
    assert found.columns == documents(spark, rows).columns
    assert {r.doc_id: r.text for r in found.collect()} == {1: "mail [email], [ip].", 2: None, 3: "", 4: "nothing here"}


def test_stages(spark, tmp_path):
    rng = random.Random(2)
    prose = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma", "tau"]) for _ in range(80))
    item, copied = prose(), prose()
    rows = [(i, prose()) for i in range(12)]
    rows += [(20, copied), (21, copied), (22, copied.upper()), (23, f"{prose()} {item}"), (24, None), (25, "123 !!"), (26, f"{prose()} a@b.de")]
    rows += [(None, prose()), (1, rows[1][1])]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, rows)
    known = stages.language(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in known.filter("doc_id IS NOT NULL").collect()) == [*range(2), 1, *range(2, 12), 20, 21, 22, 23, 26]
    single = stages.near_duplicates(spark, known, str(tmp_path))
    assert sorted(r.doc_id for r in single.filter("doc_id IS NOT NULL").collect()) == [*range(12), 20, 23, 26]
    clean = stages.decontamination(spark, single, str(tmp_path))
    assert sorted(r.doc_id for r in clean.filter("doc_id IS NOT NULL").collect()) == [*range(12), 20, 26]
    hidden = stages.personal_data(spark, clean, str(tmp_path))
    assert hidden.filter("doc_id = 26").first().text.endswith("[email]") and hidden.count() == clean.count() == 15
    assert all(frame.columns == docs.columns for frame in (known, single, clean, hidden))
    assert stages.packing(spark, hidden, str(tmp_path)).count() == 15


def test_pipeline(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 100


def test_empty_tables(spark, tmp_path):
    for name, schema in (
        ("documents", SCHEMA), ("benchmark", "item_id long, text string"), ("embeddings", "vec_id long, embedding array<float>, label int"),
        ("pages", "page_id long, url string, html string"),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in {**queries.queries(), "pipeline": corpus_pipeline.run}.items():
        assert query(spark, str(tmp_path)).collect() == [], name


def test_language(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = identify_documents(docs)
    both = found.join(docs.select("doc_id", "lang", "text"), "doc_id").filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    right, n = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 100 and right > 0.95
    assert found.count() == docs.count() and found.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    odd = identify_documents(documents(spark))
    assert {r.doc_id for r in odd.filter("lang_pred = 'und'").collect()} == {28, 29, 30, 34}


@pytest.mark.parametrize("label", [None, "und"])
def test_language_stage_rejects_by_letters_alone(spark, label):
    rows = [(i, "some words of a text") for i in range(8)] + [(20, "123 !!"), (21, None), (22, ""), (23, "x")]
    docs = documents(spark, rows).withColumn("lang", F.lit(label).cast("string"))
    kept = stages.language(spark, docs, SMALL)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [*range(8), 23]
    found = identify_documents(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and {r.lang_pred for r in found.collect()} == {"und"}


def test_near_duplicates_keep_one_row_of_each_group(spark):
    rng = random.Random(4)
    prose = lambda: " ".join(str(rng.random()) for _ in range(80))
    a, b, c, d, e = (prose() for _ in range(5))
    rows = [(1, a), (None, a), (None, f"{a} more"), (None, b), (None, f"{b} more"), (None, b)]
    rows += [(3, c), (3, f"{c} more"), (3, d), (4, f"{d} more"), (5, c), (6, e), (7, None), (None, None), (7, "")]
    docs = documents(spark, rows).repartition(5)
    kept = stages.near_duplicates(spark, docs, SMALL)
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text and r.text.removesuffix(" more")) for r in kept.collect()]
    assert Counter(kept) == Counter([(1, a), (None, b), (3, c), (3, d), (6, e), (7, None), (None, None), (7, "")])


def test_benchmark_items_without_an_id(spark, tmp_path):
    item, other = " ".join(f"i{k}" for k in range(14)), " ".join(f"o{k}" for k in range(12))
    rows = [(1, f"a b {item} c"), (2, f"{other} and {item}"), (3, f"z {other}"), (4, "nothing"), (5, "tiny thing"), (6, None)]
    items = [(None, item), (None, "thing"), (7, other), (8, other), (None, None)]
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = sorted(tuple(r) for r in contamination(docs, benchmark).collect())
    assert [(r[0], r[2], r[3], r[5]) for r in found] == [(1, 14, 1, True), (2, 26, 3, True), (3, 12, 2, True), (4, 0, 0, False), (5, 1, 1, True), (6, 0, 0, False)]
    duck = duckdb.connect()
    duck.register("documents", docs.select("doc_id", "text").toPandas().astype({"text": object}))
    duck.register("benchmark", duck.read_parquet(f"{tmp_path}/benchmark.parquet/*.parquet"))
    assert sorted(duck.sql(oracles.OP3_DECONTAMINATION).fetchall()) == found
    kept = stages.decontamination(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [4, 6]


def test_benchmark_of_many_blocks(spark, monkeypatch):
    rng = random.Random(8)
    prose = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    items = [(i if i % 5 else None, prose(15)) for i in range(40)]
    rows = [(i, f"{prose(20)} {items[i % 40][1]} {prose(5)} {items[i * 7 % 40][1]}") for i in range(60)] + [(60, None), (61, prose(50))]
    docs, benchmark = documents(spark, rows), spark.createDataFrame(items * 2, "item_id long, text string")
    whole = contamination(docs, benchmark)
    monkeypatch.setattr(decontamination, "BENCHMARK_BLOCK_BYTES", 300)
    passes = []
    search = decontamination._search_block
    monkeypatch.setattr(decontamination, "_search_block", lambda *given: passes.append(given[1]) or search(*given))
    parts = contamination(docs, benchmark)
    assert len(passes) > 5
    # No block is left in the plan, on the driver or in a broadcast.
    assert "MapInArrow" not in parts._jdf.queryExecution().toString()
    assert all(shared._jbroadcast is None or not shared._jbroadcast.isValid() for shared in passes)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    assert whole.filter("n_items > 1").count() > 10


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<article><h1>Head &amp; more</h1><p>First   <b>bold</b>
line.<p>Second &lt;tag&gt; &eacute;</p></article><aside>side</aside><section class="comments"><p>I disagree</p></section>
<form><input value="x">send</form><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    text = "Head & more\nFirst bold line.\nSecond <tag> é"
    assert extract(PAGE, None) == text
    assert [extract(source, None) for source in (None, "", "<p", "<!--", "<nav>x</nav>")] == ["", "", "", "", ""]
    rows = [(1, "http://h.example/1", PAGE), (2, None, None), (3, "x", ""), (3, "x", ""), (4, "http://H.example:80/2", PAGE)]
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in found) == [(1, text, len(text)), (2, "", 0), (3, "", 0), (3, "", 0), (4, text, len(text))]


@pytest.mark.parametrize("attributes", ['style="overflow:hidden"', 'aria-hidden="false"', 'title="Hidden gems"', "data-x='a hidden b'", "data-hidden=hidden", 'title="a > hidden'])
@pytest.mark.parametrize("tag", ["body", "div", "article"])
def test_html_keeps_values_that_say_hidden(tag, attributes):
    assert extract(f"<{tag} {attributes}><p>Some text of the page.</p></{tag}>", None).endswith("Some text of the page.")


def test_html_attributes():
    assert extract('<body><div width="600" id="comments"><p>I disagree</p></div><article><p>Text.</p></article></body>', None) == "Text."
    for hidden in ("hidden", "HIDDEN", 'hidden=""', 'id="a"hidden', "class=a hidden/"):
        assert extract(f"<body><div {hidden}><p>Not shown, however long it is.</p></div><p>Text.</p></body>", None) == "Text."


def test_html_keeps_what_stands_beside_an_inner_container(spark):
    inside = [f"Paragraph {i} " + "of the body of the text " * 20 for i in range(10)]
    body = "".join(f"<p>{text}</p>" for text in inside)
    parts = "<h1>Head</h1><p>Lead.</p><div class='body'>" + body + "</div><p>Closing.</p>"
    text = "\n".join(["Head", "Lead.", *(part.strip() for part in inside), "Closing."])
    links = "<div><a href='/1'>One link to elsewhere</a> <a href='/2'>Another one</a></div>"
    pages = [
        f"<body>{links}<article>{parts}</article>{links}<p>Beside.</p></body>",
        f"<body>{links}<main>{parts}</main>{links}</body>",
        f"<body>{links}<div id='w'><div>{parts}</div></div>{links}</body>",
    ]
    assert [extract(page, None) for page in pages] == [text] * 3
    rows = [(i, "http://h.example/", pages[0]) for i in range(3)]
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r.text for r in found] == [text] * 3


LONG = "Some words of the text. " * 30


@pytest.mark.parametrize("attributes", ['class="layout has-sidebar"', 'class="post with-comments"', 'id="search-result"', 'class="search"'])
def test_html_keeps_named_elements_that_hold_the_page(attributes):
    text = f"Head\n{LONG.strip()}"
    page = f"<nav>menu</nav><div {attributes}><h2>Head</h2><p>{LONG}</p></div><footer>f</footer>"
    assert extract(f"<body>{page}</body>", None) == text
    assert extract(f"<body><main>{page}</main></body>", None) == text


def test_html_keeps_modified_names_and_drops_others():
    page = f"<article><h1>H</h1><div class='part has-sidebar'><p>Small.</p></div><p>{LONG}</p></article>"
    assert extract(f"<body>{page}</body>", None) == f"H\nSmall.\n{LONG.strip()}"
    for name in ("ad", "ad-top", "site-footer", "sidebar left", "comments_area"):
        assert extract(f"<body><div class='{name}'><p>{LONG}{LONG}</p></div>{page}</body>", None) == f"H\nSmall.\n{LONG.strip()}"
    assert extract("<body><div class='widget'>One.</div><div class='widget'>Two.</div></body>", None) == "One.\nTwo."


@pytest.mark.parametrize("comments", [
    "<ol class='comments'>" + f"<li><article class='comment-body'><p>I disagree. {LONG}</p></article></li>" * 3 + "</ol>",
    f"<section id='comments'><article><p>I disagree. {LONG * 3}</p></article></section>",
    "<article class='comment'><p>No.</p></article>" * 3,
])
def test_html_drops_comments_marked_as_articles(comments):
    article = f"<h1>Head</h1><p>{LONG}</p>"
    text = f"Head\n{LONG.strip()}"
    assert extract(f"<body><article>{article}</article>{comments}</body>", None) == text
    assert extract(f"<body><article>{article}{comments}</article></body>", None) == text
    assert extract(f"<body><main>{article}{comments}</main></body>", None) == text


def test_html_keeps_a_page_of_comments():
    posts = "".join(f"<article class='comment'><p>Post {i}. {LONG}</p></article>" for i in range(3))
    text = "\n".join(f"Post {i}. {LONG.strip()}" for i in range(3))
    assert extract(f"<body><nav>menu</nav><div class='discussion'>{posts}</div></body>", None) == text
    assert extract(f"<body><nav>menu</nav><div class='thread'>{posts}</div></body>", None) == text


def record(name: str, body: bytes) -> bytes:
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:{name}>\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_salvage():
    parts = [record("a", b"one"), record("b", b"two\r\n\r\nWARC/1.1\r\nno"), record("c", b""), record("d", b"x" * 5000)]
    found = list(salvage(b"".join(parts)))
    assert [f.payload for f in found] == [b"one", b"two\r\n\r\nWARC/1.1\r\nno", b"", b"x" * 5000]
    broken = parts[0] + parts[1].replace(b"Content-Length: ", b"Content-Length: z") + b"junk" + parts[2] + parts[3][:-900]
    found = list(salvage(broken))
    good = [f for f in found if not isinstance(f, Gap)]
    gaps = [f for f in found if isinstance(f, Gap)]
    assert [f.payload for f in good] == [b"one", b""]
    assert gaps[0].offset == len(parts[0]) and sum(f.length for f in found) == len(broken)
    assert list(salvage(b"")) == []


def test_salvage_inside_gzip():
    rng = random.Random(6)
    bodies = [rng.randbytes(3000) + b"%d" % i for i in range(60)]
    parts = [record(str(i), body) for i, body in enumerate(bodies)]
    whole = gzip.compress(b"".join(parts))
    good = lambda data: [f.payload for f in salvage(data) if not isinstance(f, Gap)]
    gaps = lambda data: [f for f in salvage(data) if isinstance(f, Gap)]
    assert good(whole) == bodies and not gaps(whole)
    # One record in the middle is bad, the member is sound; a plain record stands before it.
    bad = [*parts[:30], parts[30].replace(b"Content-Length: ", b"Content-Length: z"), *parts[31:]]
    inner = parts[0] + gzip.compress(b"".join(bad))
    assert good(inner) == [bodies[0], *bodies[:30], *bodies[31:]]
    assert [g.offset for g in gaps(inner)] == [len(parts[0])] and "inflated bytes" in gaps(inner)[0].reason
    # Cut, also with another member after the cut.
    for after in ([], bodies[:2]):
        cut = whole[: len(whole) // 2] + b"".join(gzip.compress(record("x", body)) for body in after)
        found = good(cut)
        n = len(found) - len(after)
        assert 20 < n < 31 and found == bodies[:n] + after
        assert [g.reason for g in gaps(cut)][0].startswith("gzip member is") and len(gaps(cut)) == 1
    # Damaged: the check at the end fails, and bytes that do not inflate.
    assert good(whole[:-8] + bytes(8) + parts[0]) == [*bodies, bodies[0]]
    text = [record(str(i), b"%d " % i * 900) for i in range(900)]
    squeezed = gzip.compress(b"".join(text))
    broken = squeezed[: len(squeezed) // 2] + b"\xff" * 400 + squeezed[len(squeezed) // 2 + 400 :]
    found = good(broken)
    assert len(found) > 300 and found[:300] == [b"%d " % i * 900 for i in range(300)] and gaps(broken)
    stored = gzip.compress(b"".join(parts[:9]), 0)
    assert good(stored[:-5000]) == bodies[:7]


def test_archives(spark):
    big = "é\r\n\x00WARC/1.1\r\n" * 200
    rows = [(1, "u", big), (2, None, big), (7, "u", big), (3, "a\nb", None), (4, "", ""), (5, "x", "short"), (6, "x", "short"), (8, "x", big + " ")]
    found = archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    kinds = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in found}
    size = len(big.encode())
    assert kinds == {
        1: ("revisit", 7, size), 2: ("revisit", 7, size), 7: ("response", None, size), 3: ("response", None, 0), 4: ("response", None, 0),
        5: ("response", None, 5), 6: ("response", None, 5), 8: ("response", None, size + 1),
    }
