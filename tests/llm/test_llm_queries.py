"""The registered queries on the small tables: SQL where there is some, brute force else."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from airloom.llm import queries
from airloom.llm.common import save, table
from tools.check_oracle import TABLES, digest, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    yield c
    c.close()


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and set(queries.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_matches_sql(spark, con, key):
    df = queries.QUERIES[key](spark, SF_DIR)
    res = con.execute(queries.SQL[key])
    names = [d[0] for d in res.description]
    got, want = rows_of(df.columns, df.collect()), rows_of(names, res.fetchall())
    assert sorted(df.columns) == sorted(names) and len(got) == len(want) and digest(got) == digest(want)


def test_pipeline_stages(spark, con):
    docs = table(spark, SF_DIR, "documents")
    columns, stages = docs.columns, dict(C.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    for name in list(stages)[:-1]:
        after = save(stages[name](spark, docs, SF_DIR), "stage")
        assert after.columns == columns and after.schema == docs.schema
        now = {r.doc_id: r for r in after.collect()}
        gone = set(rows) - set(now)
        assert set(now) <= set(rows)
        if name == "quality classifier":
            junk = {i for i in rows if labels.get(i) == 0}  # some ten, so a kind of junk may have no example
            assert len(junk & gone) >= 0.75 * len(junk) and not [i for i in gone if labels.get(i) == 1]
        elif name == "simhash near-dedup":
            from test_llm_simhash import roots, slow_print

            prints = {i: slow_print(r.text) for i, r in rows.items()}
            ids = sorted(rows)
            root = roots(ids, [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 3])
            assert set(now) == set(root.values())
        elif name == "substring dedup":
            from test_llm_substring import slow

            want = {int(i): (kept, removed) for i, _, removed, kept in slow([(i, r.text) for i, r in rows.items()], 13)}
            assert {i: r.text for i, r in now.items()} == {i: kept if removed else rows[i].text for i, (kept, removed) in want.items() if kept or not removed}
            assert all(r.n_chars == len(r.text) for r in now.values() if want[r.doc_id][1])
        else:
            from airloom.llm import decontamination as D

            items = [D.tokens(t) for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
            for i, r in rows.items():
                text = " " + " ".join(D.tokens(r.text)) + " "
                if any(f" {' '.join(p)} " in text for p in items):
                    assert i in gone
            assert all(any(set(p) & set(D.tokens(rows[i].text)) for p in items) for i in gone)
        docs, rows = after, now
    pieces = stages["packing"](spark, docs, SF_DIR).collect()
    assert {p.doc_id for p in pieces} == set(rows)
    assert sorted(r[0] for r in C.run(spark, SF_DIR).select("doc_id").collect()) == sorted(p.doc_id for p in pieces)


def test_pipeline_on_odd_documents(spark, tmp_path):
    from helpers import frame

    keep = ["doc_id", "text", "lang", "source", "n_chars"]
    frame(spark).select(keep).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    ids = {p.doc_id for p in C.run(spark, str(tmp_path)).collect()}
    # of 1 and 2 (equal), 3 (other case), the row without id (equal) and the textless 4, 5, 6 one stays each
    assert {1, 4, 7, 8, 13} <= ids and not {2, 3, 5, 6, None} & ids
    frame(spark).select(keep).limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_rows_without_or_with_repeated_ids_are_judged_one_by_one(spark, tmp_path):
    from helpers import doc, frame, prose

    keep = ["doc_id", "text", "lang", "source", "n_chars"]
    item, passage = prose(70, 25), prose(71, 60)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    leak, clean, other = (f"{prose(n, 30)} {x}" for n, x in ((72, item), (73, passage), (74, prose(75, 30))))
    rows = [doc(None, leak), doc(None, clean), doc(None, f"{prose(76, 30)} {passage}"), doc(5, other), doc(5, f"{prose(77, 40)} {item}"), doc(None, other)]
    docs = frame(spark, rows).select(keep)
    left = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in C.drop_leaks(spark, docs, str(tmp_path)).collect())
    assert left == sorted((i is None, i or 0, t) for i, t in ((r[0], r[1]) for r in rows) if item not in t)
    assert sum(passage in r.text for r in C.cut_repeats(spark, docs, "").collect()) == 1
    assert sorted((r.doc_id is None, r.text) for r in C.near_dedup(spark, docs, "").collect() if r.text == other) == [(False, other)]
