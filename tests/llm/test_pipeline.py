"""The pipeline's stages against brute force, and the registered queries."""

import __spark_entry__ as entry
import corpus_pipeline
from abspark.llm import registry
from abspark.llm.language_id import known_language

from .conftest import prose
from .test_lines_and_copies import brute_components, plain_fingerprint
from .test_packing import check
from .test_secrets import base


def documents(spark):
    rows, menu = [], "Home | About | Contact"
    for i in range(80):
        lang = ("en", "de")[i % 2]
        text = f"{prose(i, 60, lang)}\n{prose(1000 + i, 50, lang)}"
        if i % 4 == 0:
            text = f"{menu}\n{text}"
        if i % 10 == 3:
            text += "\npassword = hunter2hunter2hunter2"
        rows.append((i, text, lang, "s", len(text)))
    rows += [(100 + i, rows[7][1], "de", "copy", 1) for i in range(5)] + [(110, "12 34 !!", None, None, None), (111, None, None, None, None)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, row string")


def test_stages_match_brute_force(spark, tmp_path):
    docs = documents(spark)
    path = tmp_path / "sf"
    docs.write.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
        docs.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        seen[name] = sorted(docs.collect())
    first = documents(spark).filter("doc_id < 110").collect()
    assert seen["language_id"] == sorted(first)
    lines = [r.asDict() | {"text": r.text.replace("Home | About | Contact\n", "")} for r in sorted(first)]
    assert [(r.doc_id, r.text, r.n_chars) for r in seen["line_dedup"]] == [(r["doc_id"], r["text"], len(r["text"])) for r in lines]
    label = brute_components([r["doc_id"] for r in lines], [plain_fingerprint(r["text"]) for r in lines])
    kept = [r for r, c in zip(lines, label, strict=True) if r["doc_id"] == c]
    assert [(r.doc_id, r.text) for r in seen["simhash_dedup"]] == [(r["doc_id"], r["text"]) for r in kept]
    assert 7 in {r["doc_id"] for r in kept} and 100 not in {r["doc_id"] for r in kept}
    for before, after in zip(seen["simhash_dedup"], seen["secret_scan"], strict=True):
        assert (before.doc_id, before.source) == (after.doc_id, after.source)
        assert (before.text == after.text) == (base(before.text) == []) and base(after.text) == []
        assert after.n_chars == len(after.text)
    check(seen["secret_scan"], corpus_pipeline.run(spark, str(path)).collect())


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names


def test_sql_agrees(spark):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    for name, sql in registry.oracle_sql().items():
        want = con.execute(sql)
        names = [c[0] for c in want.description]
        got = registry.queries()[name](spark, d).select(*names).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall())), name


def test_short_shared_texts_stay_and_letterless_ones_go(spark):
    rows = [(i, "De. A.", lang) for i, lang in enumerate(("en", "de", "fr", "es") * 5)] + [(90, "12 !", "en"), (91, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = lambda d: sorted(r.doc_id for r in corpus_pipeline.language_id(spark, d, "").collect())
    assert ids(docs) == list(range(20))
    assert ids(docs.selectExpr("doc_id", "text", "cast(null as string) lang")) == list(range(20))


def test_null_labels_are_filled_and_languages_chosen(spark):
    rows = [(i, prose(i, 60, ("en", "de")[i % 2]), None if i % 10 > 7 else ("en", "de")[i % 2], "clash", i) for i in range(80)]
    rows += [(None, prose(500, 60), None, "x", 0), (90, "12 !", None, "x", 0), (91, None, "de", "x", 0), (7, rows[7][1], None, "copy", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, p string, row long")
    got = known_language(docs)
    assert got.columns == docs.columns
    want = sorted(((i, t, l or ("en" if i is None else ("en", "de")[i % 2]), p, r) for i, t, l, p, r in rows if i not in (90, 91)), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    only = known_language(docs, ("de",)).collect()
    assert {r.doc_id for r in only} == {i for i in range(80) if i % 2} and {r.lang for r in only} == {"de"}
    assert known_language(docs.limit(0)).collect() == []


def test_texts_are_fingerprinted_once(spark, monkeypatch, tmp_path):
    """Nulls, empty texts, repeated ids and rows: one row a group; the costly function runs once a row in all plans."""
    from abspark.llm import simhash_ball

    long = prose(3, 80)
    rows = [(1, long, "a"), (1, long, "a"), (2, long + " x", "b"), (1, "other " + prose(4, 60), "c"), (3, None, "d"), (4, "", "e"), (None, prose(5, 40), "f"), (None, prose(5, 40), "f"), (6, "word " * 30_000, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 string")
    calls = []
    made = simhash_ball.fingerprints
    monkeypatch.setattr(simhash_ball, "fingerprints", lambda words: calls.append(words) or made(words))
    got = simhash_ball.simhash_keep(docs)
    assert len(calls) == 1 and "EvalPython" not in got._jdf.queryExecution().optimizedPlan().toString()
    label = brute_components([i for i, *_ in rows], [plain_fingerprint(t) for _, t, _ in rows])
    want = {(i, t or "") for (i, t, _), c in zip(rows, label, strict=True) if i == c}
    groups = len({c for c in label}) if None not in label else None
    kept = got.collect()
    assert got.columns == docs.columns and {(r.doc_id, r.text or "") for r in kept} <= want
    assert sum(r.doc_id in (3, 4) for r in kept) == 1 and sum(r.doc_id is None for r in kept) == 1 and (groups is None or len(kept) == groups)
    empty = simhash_ball.simhash_keep(docs.limit(0))
    assert empty.collect() == [] and empty.columns == docs.columns
