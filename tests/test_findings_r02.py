"""Cases of the findings of round 2: odd rows give the rows of the SQL, and what grew with the table does not."""

import duckdb
import pyarrow as pa
import pytest

from folioflow import catalog
from folioflow.operators import documents as D
from folioflow.operators import synthetic as G
from folioflow.sources import writers
from test_plans import plain


def differences(spark, tmp_path, name, **tables):
    """Rows of a query over given tables (rows and their DDL), and of its SQL."""
    duck = duckdb.connect()
    for table, (rows, ddl) in tables.items():
        path = f"{tmp_path}/{table}.parquet"
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(path)
        duck.sql(f"create view {table} as select * from '{path}/*.parquet'")
    df = catalog.queries()[name](spark, str(tmp_path))
    found = duck.sql(catalog.oracle_sql()[name])
    assert sorted(found.columns) == sorted(df.columns)
    own = sorted("|".join(map(plain, r)) for r in df.collect())
    return own, sorted("|".join(map(plain, r)) for r in found.project(",".join(f'"{c}"' for c in df.columns)).fetchall())


@pytest.mark.parametrize("name", ["anchor_find", "benchmark_containment", "gold_exclusion"])
def test_items_within_longer_words(spark, tmp_path, name):
    items = ["one two three four five", "one two three", "two three", "three", "", None, "a\tb c\td e", "a  b", " ", "one two\nthree four five six", "two two two two"]
    texts = [*items, "xone two three four fivex", "bone two threes", "a two threes", "a\tb c\td e f", "xa  bx", "one two\nthree four five sixty", "one\ntwo three", "two two two two two two"]
    docs = [(i, t, "en") for i, t in enumerate(texts)]
    if name == "gold_exclusion":
        items = [x for x in items if x and len(x) > 3]  # an empty item or a blank stands in nearly all
    else:
        docs += [(3, "one two three four five", "en"), (None, "bone two three four five", "en")]
    own, right = differences(spark, tmp_path, name, documents=(docs, "doc_id long, text string, lang string"), benchmark=([*enumerate(items), (0, "two three")], "item_id long, text string"))
    assert own == right and right


def test_seed_of_odd_texts(spark, tmp_path):
    texts = [None, "", "a", "\0", "a\0b", "\U0001f600x", "e\u0301", "\ufeff", " ", "\r\n", "z" * 5000, "\U0010ffff" * 300]
    own, right = differences(spark, tmp_path, "stable_seed_hash", documents=([*enumerate(texts)], "doc_id long, text string"))
    assert own == right


@pytest.mark.parametrize("columns", [["x"], ["y"], ["x", "y"]])
def test_arrow_passes_take_bounded_parts(columns):
    batch = pa.RecordBatch.from_pydict({"x": ["-", "a" * 5, None, "", "é" * 3, "z" * 40, "q"], "y": [[], ["a", None], [], None, ["bbb"], ["c" * 30], ["d"]]}).slice(1)
    found = list(D.parts(batch, columns, 8))
    assert pa.Table.from_batches(found).to_pylist() == batch.to_pylist()
    texts = [[v for r in p.to_pylist() for c in columns for v in ([r[c]] if isinstance(r[c], str) else r[c] or []) if v] for p in found]
    assert all(p.num_rows == 1 or sum(len(t.encode()) for t in t_) <= 8 for p, t_ in zip(found, texts)) and len(found) > 2


@pytest.mark.parametrize("name", ["latex_spans", "line_parse", "scaffold_mask", "typo_injection", "fuzzy_question_match", "dynamic_windows", "merge_chunks"])
def test_rows_of_a_large_batch_are_objects_in_parts(spark, tmp_path, monkeypatch, name):
    """A batch of 300 texts of 20 KB comes back as batches of a few; before, all of it was made at once."""
    rows = [(i, f"1. a $x_{i}$ b? " + "word " * 4000) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    taken = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, f, schema: taken.append((df, f)) or df)
    monkeypatch.setattr(type(spark.range(1)), "mapInPandas", lambda df, f, schema: pytest.fail("whole batches as pandas"))
    catalog.queries()[name](spark, str(tmp_path))
    df, run = taken[0]
    monkeypatch.undo()
    made = list(run(iter(df.toArrow().combine_chunks().to_batches())))
    assert sum(b.num_rows for b in made) == 300 and all(b.num_rows <= 55 for b in made)


def test_seed_in_pieces():
    for text in ("", "a", "\0", "é\U0001f600" * 5000, "x" * 4096, "\ud800y" * 4097):
        out = 0
        for c in text:
            out = (out * 31 + ord(c)) % (1 << 32)
        assert G.stable_seed(text) == out


def test_range_join_counts_without_pairs(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    balances = [None, nan, inf, -inf, 0.0, -0.0, 500.0, -500.0, 499.99, 1000.0, 1000.01, 4.995, 5.0, 5.005, 7e8, 1e300]
    suppliers = [(k, n, b) for k, (n, b) in enumerate((n, b) for n in (1, 2, None) for b in balances)] + [(4, 1, 5.0), (None, 2, 3.0), (4, 1, 5.0)]
    customers = [(k, n, b + d) for k, (n, b, d) in enumerate((n, b, d) for n in (1, 1, 3, None) for b in balances if b is not None for d in (-500, 0, 500))] + [(7, 1, None)]
    tables = {"supplier": (suppliers, "s_suppkey long, s_nationkey int, s_acctbal double"), "customer": (customers, "c_custkey long, c_nationkey int, c_acctbal double")}
    own, right = differences(spark, tmp_path, "bl_theta_range", **tables)
    assert own == right and len(right) > 10
    plan = catalog.queries()["bl_theta_range"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and ("<=" in x or ">=" in x)]


def test_text_files_come_from_several_tasks(spark, tmp_path):
    path = f"{tmp_path}/files"
    writers.text_files(spark.range(60).selectExpr("concat('d', id) as name", "concat('text ', id) as t").coalesce(1), path)
    names = [r[0] for r in spark.read.option("recursiveFileLookup", True).text(path).selectExpr("_metadata.file_name").collect()]
    assert len(names) == 60 and len({n.split("-")[1] for n in names}) > 4
