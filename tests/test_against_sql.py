"""Registered queries on tables made here, held against their SQL."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lexigraph.operators import bind
from lexigraph.queries import ORACLE_SQL, QUERIES


def write(folder, **tables):
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")
    return str(folder)


def same_as_sql(spark, folder, name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    want = sorted(map(tuple, found.fetchall()), key=repr)
    got = sorted((tuple(r) for r in QUERIES[name](spark, folder).select(columns).collect()), key=repr)
    assert got == want
    return got


def test_descriptors(spark, tmp_path):
    n = range(25)
    folder = write(tmp_path, nation={"n_nationkey": pa.array(n, pa.int64()), "n_name": [f"NATION{i}" for i in n], "n_regionkey": pa.array([i % 5 for i in n], pa.int64())})
    assert len(same_as_sql(spark, folder, "c_descriptors", "nation")) == 25


def test_prices_at_the_limit(spark, tmp_path):
    prices = [149999.49, 149999.5, 149999.99, 150000.0, 150000.49, 1.5, 2.5, 149998.5]
    n = range(len(prices))
    orders = {"o_orderkey": pa.array([i + 1 for i in n], pa.int64()), "o_custkey": pa.array([i + 7 for i in n], pa.int64()), "o_orderstatus": ["F"] * len(prices), "o_totalprice": pa.array(prices, pa.float64())}
    got = same_as_sql(spark, write(tmp_path, orders=orders), "c_schema_violations", "orders")
    assert [r[0] for r in got if r[1] == "/customer/price"] == [2, 3, 4, 5]


def test_claims_are_never_collected(spark, tmp_path):
    n, m = range(600), range(200)
    lineitem = {"l_orderkey": pa.array(n, pa.int64()), "l_linenumber": pa.array([i % 7 for i in n], pa.int32()), "l_partkey": pa.array([None if i == 5 else i % 230 for i in n], pa.int64()), "l_suppkey": pa.array([i % 12 for i in n], pa.int64()), "l_linestatus": ["O" if i % 3 else "F" for i in n]}
    part = {"p_partkey": pa.array([i // 2 for i in m], pa.int64()), "p_size": pa.array([i % 5 for i in m], pa.int64())}  # parts that are there twice, some with both bindings
    folder = write(tmp_path, lineitem=lineitem, part=part)
    same_as_sql(spark, folder, "q_claim_class", "lineitem", "part")
    claimed = QUERIES["q_claim_class"](spark, folder)
    plan = claimed._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("Join") == 1


def test_crosswalk_makes_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(bind, "SLOT", 7)
    records = spark.createDataFrame([(i, area) for i in range(40) for area in ("a", "b", None)[: i % 4]], "id long, area string")
    bridge = spark.createDataFrame([("a", "x", 5), ("b", "x", 2), ("b", "y", 3), ("a", "y", 9), (None, "x", 0), ("c", "z", 1)], "area string, kind string, n long")
    targets = spark.createDataFrame([(i, kind) for i in range(30) for kind in ("x", "y", None)[: i % 4]], "t long, kind string")
    want = records.join(bridge, "area").join(targets, "kind").groupBy("id", "t").agg(F.min("n").alias("n"))
    got = bind.crosswalk(records, bridge, targets, ["area"], ["kind"], "id", "t", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 100
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not plan.startswith("Aggregate")  # no grouping of the pairs


def test_crosswalk_without_rows(spark):
    none = spark.createDataFrame([], "id long, area string")
    bridge, targets = spark.createDataFrame([("a", "x", 5)], "area string, kind string, n long"), spark.createDataFrame([(1, "x")], "t long, kind string")
    assert bind.crosswalk(none, bridge, targets, ["area"], ["kind"], "id", "t", "n").collect() == []


def test_crosswalk_shuffles_blocks_not_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bind, "SLOT", 16)
    monkeypatch.setattr(bind, "RUN", 5)
    n, m = range(400), range(900)
    supplier = {"s_suppkey": pa.array([None if i == 3 else i for i in n], pa.int64())}
    part = {"p_partkey": pa.array([None if i < 2 else i // 2 for i in m], pa.int64()), "p_brand": [f"Brand#{1 + i % 12}" if i % 90 else None for i in m]}
    folder = write(tmp_path, supplier=supplier, part=part)
    got = same_as_sql(spark, folder, "q_crosswalk", "supplier", "part")
    assert len(got) > 20_000 and any(p is None for _, p, _ in got)
    pairs = QUERIES["q_crosswalk"](spark, folder)
    nodes = pairs._jdf.queryExecution().optimizedPlan().toString().split("\n")
    # rows of neither side are repeated before they are shuffled: pairs are made above the last shuffle, from blocks
    assert sum("Generate explode" in x for x in nodes[: next(i for i, x in enumerate(nodes) if "RepartitionByExpression" in x)]) == 4


def test_search_finds_terms_of_many_parts(spark, tmp_path):
    n = range(4 * 1176)  # four areas
    words = lambda i: "old gizmo" if i // 1176 < 3 and i % 30 == 3 else "hot anvil" if i == 4011 else "blue ring"
    part = {"p_partkey": pa.array(n, pa.int64()), "p_name": [words(i) for i in n], "p_type": ["STANDARD"] * len(n)}
    nation = {"n_nationkey": pa.array(range(25), pa.int64()), "n_name": [f"NATION{i}" for i in range(25)], "n_regionkey": pa.array([i % 5 for i in range(25)], pa.int64())}
    got = same_as_sql(spark, write(tmp_path, part=part, nation=nation), "c_search", "part")
    found = {i.split(".")[4] for call, i in got if call == "words"}
    assert found == {"A0", "A1", "A2", "A3"}  # the last area has only the phrase


def test_keyword_searches_find_terms_of_many_parts(spark, tmp_path):
    n = range(60)
    text = lambda i: "Schungheit überall" if i % 3 == 0 else "blelyedu" if i % 20 == 1 else "nichts hier" if i % 2 else None
    documents = {"doc_id": pa.array(n, pa.int64()), "lang": [("de", "en", None)[i % 3] for i in n], "source": [f"src{i % 9}" for i in n], "text": [text(i) for i in n]}
    conversations = {"text": ["nichts"]}
    folder = write(tmp_path, documents=documents, conversations=conversations)
    assert len(same_as_sql(spark, folder, "q_keyword_search", "documents")) == 20  # in three sources
    assert len(same_as_sql(spark, folder, "q_keyword_union", "documents")) == 22
    same_as_sql(spark, folder, "q_keyword_coverage", "documents", "conversations")
    assert all("," not in p or p.count(",") == 1 for _, _, p in same_as_sql(spark, folder, "q_inverted_index", "documents"))
