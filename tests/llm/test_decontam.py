import duckdb
import pytest

from zonecast.llm import decontam

ITEMS = [
    (1, "A train leaves Berlin at 60 km per hour and meets Anna after 3 hours on the way to old Hamburg by 3 rivers."),
    (2, "Which of these plants would grow best in a cold and windy place near the northern sea shore?"),
    (6, "Take 3 apples and 3 pears and 3 plums and 3 figs from the old wooden table in the hall."),
    (3, "too short here"),
    (4, None),
    (5, ""),
]
DOCS = [
    (1, "Some words before. A train leaves Paris at 85 km per hour and meets Maria after 7 hours on the way to old Lyon by 7 rivers. And after."),  # new values, consistent
    (2, "Take 1 apples and 2 pears and 5 plums and 9 figs from the old wooden table in the hall."),  # 3 -> 1, 2, 5, 9
    (11, "Take 8 apples and 8 pears and 8 plums and 8 figs from the old wooden table in the hall."),
    (3, "x " * 3000 + "which OF these plants would grow best in a cold and windy place near the northern sea shore? " + "y " * 500),
    (4, "Which of these plants would do fine, I do not know at all, says he."),
    (5, None),
    (6, ""),
    (None, ITEMS[1][1]),
    (7, ITEMS[1][1]),
    (7, ITEMS[1][1]),
    (8, "Too short here"),
    (9, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18"),
    (10, "word " * 30000),
]


def frames(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 as item_id", "'w' as window", "0 as pos")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "5 as doc_id")


def test_reparameterised_questions(spark):
    docs, items = frames(spark)
    got = {(r.doc_id, r.item_id): r for r in decontam.leaks(docs, items).collect()}
    assert set(got) == {(1, 1), (3, 2), (7, 2), (11, 6)}
    assert got[1, 1].consistency == 1.0 and got[1, 1].n_slots >= 7 and got[1, 1].n_hit == got[1, 1].n_windows
    loose = {r.doc_id: r.consistency for r in decontam.leaks(docs, items, consistency=0.0).collect()}
    assert 0 < loose[2] < 1


def test_filter_keeps_the_rest(spark):
    docs, items = frames(spark)
    kept = decontam.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["2", "4", "5", "6", "None", "8", "9", "10"])


def test_without_rows(spark):
    docs, items = frames(spark)
    assert decontam.leaks(docs.limit(0), items).count() == 0
    assert decontam.leaks(docs, items.limit(0)).count() == 0
    assert decontam.drop_leaks(docs, items.limit(0)).count() == len(DOCS)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    docs, items = frames(spark)
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} == {(1, 1), (3, 2), (7, 2), (11, 6)}


def rounded(rows):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("source", ["small", "sf0.01"])
def test_equals_sql(spark, scratch, source):
    if source == "small":
        docs, items = (f.select(k, "text") for f, k in zip(frames(spark), ("doc_id", "item_id"), strict=True))
        docs.write.parquet(f"{scratch}/documents.parquet")
        items.write.parquet(f"{scratch}/benchmark.parquet")
        place = {t: f"{scratch}/{t}.parquet/*.parquet" for t in ("documents", "benchmark")}
    else:
        docs, items = (spark.read.parquet(f"/root/testdata/{source}/{t}.parquet") for t in ("documents", "benchmark"))
        place = {t: f"/root/testdata/{source}/{t}.parquet" for t in ("documents", "benchmark")}
    con = duckdb.connect()
    for t, p in place.items():
        con.execute(f"create view {t} as select * from '{p}'")
    want = con.sql(decontam.ORACLE)
    got = decontam.leaks(docs, items)
    assert want.columns == got.columns
    assert rounded(got.collect()) == rounded(want.fetchall()) and got.count() > 0


def test_no_python_in_the_plan(spark):
    docs, items = frames(spark)
    plan = decontam.leaks(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


LONG_RUNS = [
    (101, "so " + "Anna " * 200_000 + "went home"),  # one name of 200,000 words
    (102, "see 1" + ".1" * 200_000 + " and 5" + ",000" * 50_000 + " km"),  # one number
    (103, "x" * 1_000_000 + " " + "9" * 1_000_000 + " km " + "Ä" * 300_000),
    (104, "A train leaves " + "Berlin " * 50_000 + "at 60 km per hour and meets Anna after 3 hours on the way to old Hamburg by 3 rivers."),
]


def test_long_runs_of_names_and_numbers(spark):
    docs = spark.createDataFrame(LONG_RUNS + DOCS[:1], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} == {(1, 1), (104, 1)}
    tokens = docs.where("doc_id = 102").select(decontam.template(docs.text).alias("t")).collect()[0].t
    assert tokens == ["see", "§num", "and", "§num", "§unit"]


def test_a_window_that_many_items_and_documents_share(spark):
    """Only the rarest windows of an item lead to pairs; pairs that share common ones alone never meet."""
    common = "please answer the following question as briefly as you possibly can today"
    word = lambda n: "".join("abcdefghij"[int(c)] for c in str(n))
    tail = lambda k: " ".join(f"w{word(k)}x{word(j)}" for j in range(12))
    items = spark.createDataFrame([(i, f"{common} {tail(i)}") for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(d, f"{common} {tail(1000 + d)}") for d in range(300)] + [(1000 + i, f"{common} {tail(i)}") for i in range(0, 40, 8)], "doc_id long, text string")
    wins = lambda t, k: decontam.windows(t, k, "text")
    matched = wins(docs, "doc_id").selectExpr("doc_id", "pos as dpos", "window")
    pairs = decontam._candidates(matched, wins(items, "item_id").selectExpr("item_id", "pos as ipos", "window").distinct(), 0.5)
    assert {(r.doc_id, r.item_id) for r in pairs.collect()} == {(1000 + i, i) for i in range(0, 40, 8)}
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} == {(1000 + i, i) for i in range(0, 40, 8)}
