"""The engine's operators as queries over the driver tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .derived import made
from .functions import ids, text as tx
from .operators import anchor, bind, diff, graph, index, match, quality, rank
from .session import small, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def long(name: str):
    return F.col(name).cast("long").alias(name)


def _minted(spark: SparkSession, d: str) -> DataFrame:
    """Customers with an identifier made from their columns; some break the grammar."""
    c = table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    subject = F.element_at(F.array(F.lit("M"), F.lit("D"), F.lit("E"), F.lit("SU")), (F.col("c_nationkey") % 4 + 1).cast("int"))
    area = F.when(F.col("c_custkey") % 23 == 0, "AB").when(F.col("c_custkey") % 7 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    value = F.concat(F.lit("AT.LP23.SEK1."), subject, F.lit("."), area, F.lit(".K"), (F.col("c_nationkey") % 5).cast("string"), F.lit("."), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"))
    return c.select("c_custkey", value.alias("id"))


_MINTED = """minted AS (SELECT c_custkey, 'AT.LP23.SEK1.' || ['M','D','E','SU'][(c_nationkey % 4 + 1)] || '.' ||
  CASE WHEN c_custkey % 23 = 0 THEN 'AB' WHEN c_custkey % 7 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END
  || '.K' || CAST(c_nationkey % 5 AS VARCHAR) || '.' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS id FROM customer)"""
_LEGAL = "regexp_matches(id, '^AT[.]LP23[.]SEK1[.](D|E|M)[.][A-Z][A-Z0-9]*[.]K[1-4][.][0-9]{2}$') AND NOT regexp_matches(id, '[.](AB|DT)[.]')"


@query(f"""WITH {_MINTED} SELECT c_custkey, id, CASE WHEN {_LEGAL} THEN 'competence' END AS kind, CASE WHEN {_LEGAL} THEN split_part(id, '.', 3) END AS band,
  CASE WHEN {_LEGAL} THEN split_part(id, '.', 4) END AS subject, CASE WHEN {_LEGAL} THEN split_part(id, '.', 5) END AS area,
  CASE WHEN {_LEGAL} THEN split_part(id, '.', 6) END AS level, CASE WHEN {_LEGAL} THEN CAST(split_part(id, '.', 7) AS BIGINT) END AS ordinal FROM minted""")
def q_id_parse(spark, d):
    return ids.parse(_minted(spark, d), "id", ids.COMPETENCE).withColumn("ordinal", F.col("ordinal").cast("long"))


@query(f"""WITH {_MINTED}, n AS (SELECT id AS value, count(*) AS n, {_LEGAL} AS legal FROM minted GROUP BY id)
  SELECT value, CASE WHEN NOT legal THEN 'malformed-id' ELSE 'id-collision' END AS rule, n FROM n WHERE NOT legal OR n > 1""")
def q_id_validate(spark, d):
    return ids.validate(_minted(spark, d), "id", ids.COMPETENCE.pattern)


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN trim(c_name) ELSE trim(c_mktsegment) || ' ' || trim(c_name) END AS wording FROM customer")
def q_volltext(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    return c.select("c_custkey", tx.full_wording(F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_mktsegment")), F.col("c_name")).alias("wording"))


@query("SELECT doc_id, CAST(length(replace(lower(text), 'ß', 'ss')) AS BIGINT) AS folded_chars FROM documents WHERE contains(replace(lower(text), 'ß', 'ss'), 'heitss')")
def q_casefold_filter(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text")
    return docs.where(index.has_term(F.col("text"), ["HEITß"])).select("doc_id", F.length(tx.casefold(F.col("text"))).cast("long").alias("folded_chars"))


_INDEX = r"""pairs AS (SELECT DISTINCT lang, source, replace(lower(t), 'ß', 'ss') AS term FROM
  (SELECT lang, source, unnest(regexp_extract_all(text, '[\p{L}\p{Nl}\p{No}]+')) AS t FROM documents) WHERE length(t) >= 4),
  idx AS (SELECT lang, term, string_agg(source, ',' ORDER BY source) AS parts, count(*) AS n FROM pairs GROUP BY lang, term HAVING count(*) <= 2)"""
_WHOLE_INDEX = _INDEX.replace(" HAVING count(*) <= 2)", ")")  # searches find terms of any number of parts


def _built_index(spark, d, most_parts: int | None = 2):
    return index.inverted_index(table(spark, d, "documents", "text", "lang", "source"), F.col("text"), "source", ["lang"], most_parts, stop=())


def _keyword_index(spark, d):
    """The stored index of the documents with all terms, written once in an application as a build writes it; searches read it."""
    return spark.read.parquet(made(spark, d, "postings", lambda folder: _built_index(spark, d, None).write.parquet(folder)))


@query(f"WITH {_INDEX} SELECT lang, term, parts FROM idx")
def q_inverted_index(spark, d):
    return index.packed_postings(_built_index(spark, d))


def _search(terms: list[str]):
    hit = " OR ".join(f"contains(term, '{t}')" for t in terms)
    seen = " OR ".join(f"contains(replace(lower(text), 'ß', 'ss'), '{t}')" for t in terms)
    sql = f"""WITH {_WHOLE_INDEX}, routed AS (SELECT DISTINCT unnest(string_split(parts, ',')) AS source FROM idx WHERE {hit})
      SELECT doc_id, lang, source FROM documents WHERE ({seen}) AND source IN (SELECT source FROM routed)"""

    def run(spark, d):
        docs = table(spark, d, "documents", "doc_id", "lang", "source", "text")
        return index.routed_search(docs, F.col("text"), "source", _keyword_index(spark, d), terms).select("doc_id", "lang", "source")

    return sql, run


_one, _two = _search(["ungheit"]), _search(["ungheit", "blelyed", "ciónmente"])


@query(_one[0])
def q_keyword_search(spark, d):
    return _one[1](spark, d)


@query(_two[0])
def q_keyword_union(spark, d):
    return _two[1](spark, d)


_TERMS = ["idiot", "ungheit", "qqqq", "heitzutz"]


@query(f"""WITH {_INDEX}, w AS (SELECT unnest({_TERMS}) AS term) SELECT term, CASE WHEN EXISTS (SELECT 1 FROM conversations c WHERE contains(replace(lower(c.text), 'ß', 'ss'), w.term)) THEN 'title'
  WHEN EXISTS (SELECT 1 FROM documents t WHERE contains(replace(lower(t.text), 'ß', 'ss'), w.term)) THEN 'item'
  WHEN EXISTS (SELECT 1 FROM idx i WHERE contains(i.term, w.term)) THEN 'index_only' ELSE 'none' END AS status FROM w""")
def q_keyword_coverage(spark, d):
    return index.coverage(index.selective(_keyword_index(spark, d)), table(spark, d, "conversations", "text"), F.col("text"), table(spark, d, "documents", "text"), F.col("text"), _TERMS)


@query("""SELECT source, count(*) AS records, CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS bytes, CAST(coalesce(sum(greatest(1, strlen(text) // 4)), 0) AS BIGINT) AS tokens FROM documents GROUP BY source""")
def q_part_catalog(spark, d):
    return index.part_catalog(table(spark, d, "documents", "source", "text"), F.col("text"), "source")


def _orders(spark, d, *more):
    return table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", *more).withColumn("level", F.year("o_orderdate") - 1994)


_ORDERS = "o AS (SELECT o_orderkey, o_custkey, o_orderpriority, year(o_orderdate) - 1994 AS level FROM orders)"


@query(f"""WITH {_ORDERS}, s AS (SELECT o_custkey, level, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids FROM o GROUP BY ALL)
  SELECT o_orderkey, coalesce(b.ids, '') AS before, coalesce(a.ids, '') AS after FROM o LEFT JOIN s b ON b.o_custkey = o.o_custkey AND b.level = o.level - 1
  LEFT JOIN s a ON a.o_custkey = o.o_custkey AND a.level = o.level + 1""")
def q_progression(spark, d):
    p = graph.progression(_orders(spark, d), "o_orderkey", ["o_custkey"], "level")
    return p.select("o_orderkey", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("before", "after")])


@query(f"""WITH {_ORDERS} SELECT a.o_orderkey, b.o_orderkey AS next FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND b.level = a.level + 1""")
def q_progression_edges(spark, d):
    return graph.edges(_orders(spark, d), "o_orderkey", ["o_custkey"], "level")


@query("""WITH r AS (SELECT l_orderkey AS key, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - 1 AS pos, l_partkey AS target FROM lineitem)
  SELECT key, CAST(pos AS BIGINT) AS pos, target, CASE WHEN p_partkey IS NULL THEN 'unknown' WHEN p_type = 'ECONOMY' THEN 'foreign' ELSE 'ok' END AS status
  FROM r LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = target""")
def q_progression_resolve(spark, d):
    lines = table(spark, d, "lineitem", "l_orderkey", "l_partkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("parts"))
    parts = table(spark, d, "part", "p_partkey", "p_type", "p_size").where("p_size > 10")
    return graph.resolve(lines, "l_orderkey", "parts", parts, "p_partkey", F.col("b.p_type") != "ECONOMY").select("key", long("pos"), "target", "status")


@query(f"""WITH {_ORDERS}, s AS (SELECT o_custkey, level, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) AS ids FROM o GROUP BY ALL)
  SELECT o_orderkey, coalesce(ids, '') AS targets, CASE WHEN o.level <= 1 THEN 'first-level' WHEN ids IS NULL THEN 'no-target' END AS issue
  FROM o LEFT JOIN s ON s.o_custkey = o.o_custkey AND s.level = o.level - 1 WHERE o_orderpriority = '1-URGENT'""")
def q_backlink(spark, d):
    o = _orders(spark, d, "o_orderpriority").withColumn("target", F.col("o_orderkey").cast("string"))
    found = graph.back_links(o, F.col("o_orderpriority").rlike("^\\s*1-URGENT"), o, "o_orderkey", "target", ["o_custkey"], "level")
    return found.withColumn("targets", F.array_join("targets", ","))


_BINDING = "CASE n_regionkey WHEN 0 THEN 'kompetenz' WHEN 1 THEN 'bereich' WHEN 2 THEN 'stufe' WHEN 3 THEN 'prosa' ELSE 'keine' END"


def _key_sql(k: str) -> str:
    return f"CASE {_BINDING} WHEN 'kompetenz' THEN 'id' || ({k} % 50) WHEN 'bereich' THEN 'A' || ({k} % 3) || '.K' || ({k} % 4 + 1) WHEN 'stufe' THEN 'K' || ({k} % 4 + 1) END"


def _bound(rows: DataFrame, nation: DataFrame, key: str, nation_key: str) -> DataFrame:
    binding = F.expr(_BINDING)
    k = F.col(key)
    own, area, level = F.concat(F.lit("id"), (k % 50).cast("string")), F.concat(F.lit("A"), (k % 3).cast("string")), F.concat(F.lit("K"), (k % 4 + 1).cast("string"))
    return rows.join(small(nation), F.col(nation_key) == F.col("n_nationkey")).select(key, F.col("n_nationkey").alias("scope"), binding.alias("binding"), bind.attach_key(binding, own, area, level).alias("attach_key"))


@query(f"""WITH c AS (SELECT c_custkey, n_nationkey AS scope, {_BINDING} AS binding, {_key_sql('c_custkey')} AS k FROM customer JOIN nation ON n_nationkey = c_nationkey),
  s AS (SELECT s_suppkey, n_nationkey AS scope, {_key_sql('s_suppkey')} AS k FROM supplier JOIN nation ON n_nationkey = s_nationkey)
  SELECT c_custkey, binding, count(s_suppkey) AS items, CAST(coalesce(sum(s_suppkey), 0) AS BIGINT) AS item_sum FROM c LEFT JOIN s ON s.scope = c.scope AND s.k = c.k GROUP BY c_custkey, binding""")
def q_dispatch_lookup(spark, d):
    nation = table(spark, d, "nation", "n_nationkey", "n_regionkey")
    records = _bound(table(spark, d, "customer", "c_custkey", "c_nationkey"), nation, "c_custkey", "c_nationkey")
    items = _bound(table(spark, d, "supplier", "s_suppkey", "s_nationkey"), nation, "s_suppkey", "s_nationkey").drop("binding")
    return bind.attached(records, items, "scope").groupBy("c_custkey", "binding").agg(F.count("s_suppkey").alias("items"), F.coalesce(F.sum("s_suppkey"), F.lit(0)).alias("item_sum"))


@query("SELECT c_custkey AS pos, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def q_coord_lookup(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").withColumnRenamed("c_custkey", "pos")
    return bind.at_coordinates(c, F.col("c_mktsegment") == "BUILDING")


_BRIDGE = [("BUILDING", "Brand#1", 1), ("BUILDING", "Brand#2", 2), ("MACHINERY", "Brand#2", 3), ("MACHINERY", "Brand#7", 4), ("HOUSEHOLD", "Brand#11", 5), ("FURNITURE", "Brand#1", 6), ("FURNITURE", "Brand#11", 7), ("BUILDING", "Brand#1", 8)]


@query(f"""WITH bridge(c_mktsegment, p_brand, o) AS (VALUES {', '.join(map(str, _BRIDGE))})
  SELECT s_suppkey, p_partkey, CAST(min(o) AS BIGINT) AS bridge_row FROM (SELECT s_suppkey, ['BUILDING','MACHINERY','HOUSEHOLD','FURNITURE','AUTOMOBILE'][s_suppkey % 5 + 1] AS c_mktsegment FROM supplier) s
  JOIN bridge USING (c_mktsegment) JOIN part USING (p_brand) GROUP BY s_suppkey, p_partkey""")
def q_crosswalk(spark, d):
    bridge = spark.createDataFrame(_BRIDGE, "area string, p_brand string, bridge_row long")
    area = F.element_at(F.array(*[F.lit(x) for x in ("BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE", "AUTOMOBILE")]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    records = table(spark, d, "supplier", "s_suppkey").withColumn("area", area)
    return bind.crosswalk(records, bridge, table(spark, d, "part", "p_partkey", "p_brand"), ["area"], ["p_brand"], "s_suppkey", "p_partkey", "bridge_row")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'SCH' ELSE 'K' END || substr(o_orderpriority, 1, 1) AS level, o_orderkey % 3 <> 0 AND CAST(substr(o_orderpriority, 1, 1) AS INT) >= 3 AS open FROM orders")
def q_axis_gate(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderpriority")
    o = o.select("o_orderkey", F.concat(F.when(F.col("o_orderkey") % 3 == 0, "SCH").otherwise("K"), F.substring("o_orderpriority", 1, 1)).alias("level"))
    return bind.gated(o, F.col("level"), F.lit("K3"))


_LEGEND = {str(i): f"theme {i}" for i in range(1, 14)}


@query("""WITH e AS (SELECT event_id, CAST(props->>'$.k' AS INT) AS k FROM events), c AS (SELECT event_id, unnest([k % 17, k % 5]) AS n, unnest([1, 2]) AS i FROM e),
  f AS (SELECT event_id, n, min(i) AS i FROM c GROUP BY event_id, n)
  SELECT event_id, coalesce(string_agg('theme ' || n, '|' ORDER BY i) FILTER (WHERE n BETWEEN 1 AND 13), '') AS themes FROM f GROUP BY event_id""")
def q_theme_resolve(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    legend = F.create_map(*[F.lit(x) for kv in _LEGEND.items() for x in kv])
    marker = F.concat_ws(", ", F.lpad((k % 17).cast("string"), 2, "0"), (k % 5).cast("string"))
    return table(spark, d, "events", "event_id", "props").select("event_id", F.array_join(tx.theme_names(marker, legend), "|").alias("themes"))


@query("SELECT DISTINCT source FROM documents WHERE lang = 'de' AND contains(lower(text), 'schungheit') ORDER BY source")
def q_theme_catalog(spark, d):
    docs = table(spark, d, "documents", "source", "lang", "text").where("lang = 'de'")
    meta = docs.groupBy("source").agg(F.collect_set(F.when(F.contains(F.lower("text"), F.lit("schungheit")), "SCHUNGHEIT").otherwise("Anderes")).alias("themes"))
    return bind.theme_catalog(meta, "source", "themes", F.lit("schungheit"))


@query("""WITH l AS (SELECT c_custkey, c_mktsegment AS bucket, lower(substr(c_name, 10)) AS form, c_custkey % 40 AS ordinal FROM customer),
  r AS (SELECT s_suppkey, ['BUILDING','MACHINERY','HOUSEHOLD','FURNITURE'][s_suppkey % 4 + 1] AS bucket, lower(substr(s_name, 10)) AS form, s_suppkey % 40 AS ordinal FROM supplier),
  e AS (SELECT bucket, form, arg_min(s_suppkey, ordinal * 1000000 + s_suppkey) AS s FROM r GROUP BY ALL), p AS (SELECT bucket, ordinal, min(s_suppkey) AS s FROM r GROUP BY ALL)
  SELECT c_custkey, coalesce(e.s, p.s) AS s_suppkey, CASE WHEN e.s IS NOT NULL THEN 'exact' WHEN p.s IS NOT NULL THEN 'positional' ELSE 'unmatched' END AS mode
  FROM l LEFT JOIN e USING (bucket, form) LEFT JOIN p ON p.bucket = l.bucket AND p.ordinal = l.ordinal""")
def q_cascade_exact(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").select("c_custkey", F.col("c_mktsegment").alias("bucket"), F.lower(F.substring("c_name", 10, 99)).alias("form"), (F.col("c_custkey") % 40).alias("ordinal"))
    area = F.element_at(F.array(*[F.lit(x) for x in ("BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE")]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    s = table(spark, d, "supplier", "s_suppkey", "s_name").select("s_suppkey", area.alias("bucket"), F.lower(F.substring("s_name", 10, 99)).alias("form"), (F.col("s_suppkey") % 40).alias("ordinal"))
    # a threshold above 1 leaves out the similarity step, which q_cascade_join has
    return match.cascade_join(c, s, ["bucket"], "c_custkey", "form", "ordinal", "s_suppkey", threshold=1.1).select("c_custkey", "s_suppkey", "mode")


def _similar_names() -> str:
    """Every pair of names that the parts can have, as the cascade's forms, from the threshold on: brute force."""
    names = [f"{a} {b}" for a in "blue cold hot large new old red small".split() for b in "anvil bolt gear gizmo plate ring rod widget".split()]
    pairs = ((x + more, y + "s", SequenceMatcher(None, x + more, y + "s").ratio()) for x in names for more in ("", " set") for y in names)
    return ", ".join(f"('{x}', '{y}', CAST('{r!r}' AS DOUBLE))" for x, y, r in pairs if r >= 0.9)


@query(f"""WITH l AS (SELECT p_partkey, p_brand AS bucket, p_name || CASE p_partkey % 5 WHEN 0 THEN ' set' ELSE '' END AS form, p_size AS ordinal FROM part),
  r AS (SELECT p_brand AS bucket, p_name || 's' AS form, min(p_partkey) AS other, min(p_size) AS ordinal FROM part GROUP BY ALL), sim(a, b, score) AS (VALUES {_similar_names()}),
  f AS (SELECT p_partkey, other, score, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, r.ordinal, r.other) AS n FROM l JOIN r USING (bucket) JOIN sim ON a = l.form AND b = r.form),
  p AS (SELECT bucket, ordinal, min(other) AS other FROM r GROUP BY ALL)
  SELECT l.p_partkey, coalesce(f.other, p.other) AS other, CASE WHEN f.other IS NOT NULL THEN 'fuzzy' WHEN p.other IS NOT NULL THEN 'positional' ELSE 'unmatched' END AS mode, f.score
  FROM l LEFT JOIN f ON f.p_partkey = l.p_partkey AND f.n = 1 LEFT JOIN p ON p.bucket = l.bucket AND p.ordinal = l.ordinal""")
def q_cascade_join(spark, d):
    part = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size")
    left = part.select("p_partkey", F.col("p_brand").alias("bucket"), tx.match_form(F.concat_ws(" ", "p_name", F.when(F.col("p_partkey") % 5 == 0, "set").when(F.col("p_partkey") % 5 == 1, "."))).alias("form"), F.col("p_size").alias("ordinal"))
    right = part.groupBy(F.col("p_brand").alias("bucket"), F.concat(F.col("p_name"), F.lit("s")).alias("form")).agg(F.min("p_partkey").alias("other"), F.min("p_size").alias("ordinal"))
    return match.cascade_join(left, right, ["bucket"], "p_partkey", "form", "ordinal", "other")


@query("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def q_verbatim_contains(spark, d):
    items = table(spark, d, "benchmark", "item_id", "text").withColumnRenamed("text", "quote")
    return match.contained(table(spark, d, "documents", "doc_id", "text"), "text", items, "quote").select("doc_id", "item_id")


@query("""SELECT 'hard' AS severity, 'missing-required-field' AS rule, CAST(o_orderkey AS VARCHAR) AS record, 'o_clerk' AS message FROM orders WHERE o_orderkey % 11 = 0
  UNION ALL SELECT 'hard', 'missing-required-field', CAST(o_orderkey AS VARCHAR), 'o_note' FROM orders WHERE o_orderstatus = 'P'""")
def q_missing_required(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus").withColumns({"o_clerk": F.when(F.col("o_orderkey") % 11 != 0, "x"), "o_note": F.when(F.col("o_orderstatus") == "P", "  ").otherwise("y")})
    return quality.missing_required(o, F.col("o_orderkey"), "o_orderkey", "o_clerk", "o_note")


@query("SELECT md5(text) AS digest, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def q_collision(spark, d):
    return quality.collisions(table(spark, d, "documents", "text").select(F.md5(F.col("text").cast("binary")).alias("digest")), "digest")


@query("""SELECT l_orderkey * 100 + l_linenumber AS line, count(*) AS n, count(DISTINCT (l_partkey, l_returnflag)) AS contents FROM lineitem GROUP BY 1
  HAVING count(*) > 1 AND NOT (bool_and(l_linestatus = 'O') AND count(DISTINCT (l_partkey, l_returnflag)) = 1)""")
def q_repeat_aware(spark, d):
    lines = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus").withColumn("line", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return quality.repeat_aware_collisions(lines, "line", F.col("l_linestatus") == "O", "l_partkey", "l_returnflag")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_dangling_refs(spark, d):
    return quality.dangling(table(spark, d, "documents", "doc_id"), "doc_id", table(spark, d, "labels", "doc_id"), "doc_id")


@query("""WITH k AS (SELECT event_id, CAST(props->>'$.k' AS INT) AS k FROM events), s AS (SELECT event_id, list_distinct([k % 3, k % 5]) AS h, list_distinct([k % 2, k % 5]) AS t FROM k),
  x AS (SELECT event_id, list_sort(list_filter(h, lambda a: NOT list_contains(t, a))) AS l, list_sort(list_filter(t, lambda a: NOT list_contains(h, a))) AS r FROM s)
  SELECT event_id, array_to_string(l, '|') AS only_left, array_to_string(r, '|') AS only_right FROM x WHERE len(l) > 0 OR len(r) > 0""")
def q_symmetric_tokens(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    out = quality.symmetric_difference(table(spark, d, "events", "event_id", "props"), F.col("event_id"), F.array(k % 3, k % 5), F.array(k % 2, k % 5))
    return out.select("event_id", *[F.array_join(F.col(c).cast("array<string>"), "|").alias(c) for c in ("only_left", "only_right")])


@query("""WITH f AS (SELECT source, count(*) AS records, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY source), s AS (SELECT source, count(*) AS records, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents WHERE source <> 'src3' GROUP BY source),
  j AS (SELECT coalesce(f.source, s.source) AS source, f.records AS fr, s.records AS sr, f.bytes AS fb, s.bytes AS sb FROM f FULL JOIN s ON f.source = s.source)
  SELECT source, 'records' AS field, CAST(sr AS VARCHAR) AS stored, CAST(fr AS VARCHAR) AS found FROM j WHERE fr IS DISTINCT FROM sr
  UNION ALL SELECT source, 'bytes', CAST(sb AS VARCHAR), CAST(fb AS VARCHAR) FROM j WHERE fb IS DISTINCT FROM sb""")
def q_reconcile_index(spark, d):
    docs = table(spark, d, "documents", "source", "text", "n_chars")
    found = index.part_catalog(docs, F.col("text"), "source")
    stored = docs.where("source <> 'src3'").groupBy("source").agg(F.count("*").alias("records"), F.sum("n_chars").alias("bytes"))
    return quality.reconcile(stored, found, ["source"], "records", "bytes")


_EXPECTED = [("region", 5), ("nation", 25), ("segments", 5), ("priorities", 6)]


@query(f"""WITH m AS (SELECT 'region' AS name, count(*) AS measured FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'segments', count(DISTINCT c_mktsegment) FROM customer
  UNION ALL SELECT 'priorities', count(DISTINCT o_orderpriority) FROM orders), e(name, expected) AS (VALUES {', '.join(map(str, _EXPECTED))})
  SELECT name, CAST(expected AS BIGINT) AS expected, measured, expected = measured AS matches FROM e JOIN m USING (name)""")
def q_expected_counts(spark, d):
    one = lambda name, t, c: table(spark, d, t).agg(c.alias("measured")).select(F.lit(name).alias("name"), "measured")
    measured = one("region", "region", F.count("*")).unionByName(one("nation", "nation", F.count("*"))).unionByName(one("segments", "customer", F.count_distinct("c_mktsegment"))).unionByName(one("priorities", "orders", F.count_distinct("o_orderpriority")))
    return quality.expected_counts(measured, spark.createDataFrame(_EXPECTED, "name string, expected long"))


@query(f"""WITH {_MINTED}, f AS (SELECT 'soft' AS severity, 'malformed-id' AS rule FROM minted WHERE NOT ({_LEGAL})
  UNION ALL SELECT 'hard', 'missing-required-field' FROM documents WHERE trim(text) = '' OR text IS NULL OR lang IS NULL
  UNION ALL SELECT 'soft', 'dangling-reference' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'info', 'unknown-enum-value' FROM documents WHERE lang NOT IN ('en', 'de') UNION ALL SELECT 'soft', 'size-target-exceeded' FROM documents WHERE strlen(text) > 50000 OR strlen(text) // 4 > 15000)
  SELECT severity, rule, count(*) AS n FROM f GROUP BY ALL""")
def q_findings_rollup(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "lang")
    lost = quality.dangling(table(spark, d, "orders", "o_orderkey", "o_custkey"), "o_custkey", table(spark, d, "customer", "c_custkey"), "c_custkey")
    return quality.roll_up(quality.together(
        quality.pattern_violations(_minted(spark, d), F.col("c_custkey"), F.col("id"), ids.COMPETENCE.pattern),
        quality.missing_required(docs, F.col("doc_id"), "text", "lang"),
        quality.finding(lost, quality.SOFT, "dangling-reference", F.col("o_orderkey"), F.col("o_custkey").cast("string")),
        quality.unknown_values(docs, F.col("doc_id"), F.col("lang"), ["en", "de"]),
        quality.oversize(docs, F.col("doc_id"), F.col("text")),
    ))


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_custkey AS VARCHAR) AS cust FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
  b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 26 = 0 OR o_orderkey % 7 = 0 THEN 'new' ELSE o_orderpriority END AS o_orderpriority,
    CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE CAST(o_custkey AS VARCHAR) END AS cust FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01'),
  j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a, b, a.o_orderkey AS ak, b.o_orderkey AS bk FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey),
  c AS (SELECT o_orderkey, CASE WHEN ak IS NULL THEN 'added' ELSE 'removed' END AS side, '*' AS field, CAST(NULL AS VARCHAR) AS baseline, CAST(NULL AS VARCHAR) AS candidate FROM j WHERE ak IS NULL OR bk IS NULL
    UNION ALL SELECT o_orderkey, 'changed', 'o_orderstatus', a.o_orderstatus, b.o_orderstatus FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
    UNION ALL SELECT o_orderkey, 'changed', 'o_orderpriority', a.o_orderpriority, b.o_orderpriority FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND a.o_orderpriority IS DISTINCT FROM b.o_orderpriority
    UNION ALL SELECT o_orderkey, 'changed', 'cust', a.cust, b.cust FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND a.cust IS DISTINCT FROM b.cust)
  SELECT o_orderkey, side, field, baseline, candidate, CASE WHEN side <> 'changed' THEN 'document-' || side WHEN field = 'o_orderstatus' THEN 'amendment'
    WHEN field = 'o_orderpriority' THEN CASE WHEN bool_or(field = 'o_orderstatus') OVER (PARTITION BY o_orderkey) THEN 'amendment' ELSE 'silent-republication' END WHEN field = 'cust' THEN 'repeal' ELSE 'metadata' END AS category FROM c""")
def q_snapshot_diff(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate").withColumn("cust", F.col("o_custkey").cast("string"))
    a = o.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    k = F.col("o_orderkey")
    b = o.where(F.col("o_orderdate") >= F.lit("1995-06-01").cast("timestamp_ntz")).withColumns({"o_orderstatus": F.when(k % 13 == 0, "X").otherwise(F.col("o_orderstatus")), "o_orderpriority": F.when((k % 26 == 0) | (k % 7 == 0), "new").otherwise(F.col("o_orderpriority")), "cust": F.when(k % 5 == 0, "0").otherwise(F.col("cust"))})
    changes = diff.field_changes(a, b, "o_orderkey", "o_orderstatus", "o_orderpriority", "cust")
    return diff.classified(changes, "o_orderkey", ["o_orderstatus"], ["o_orderpriority"], out_of_force="cust")


def _ranked(spark, d):
    docs = table(spark, d, "documents", "doc_id", "lang", "source", "text").withColumn("tokens", tx.token_estimate(F.col("text"))).drop("text")
    return rank.top_k(docs, 20, *rank.relevance(F.col("source") == "src7", F.col("lang") == "de"), F.col("doc_id"))


_RANKED = "k AS (SELECT doc_id, greatest(1, strlen(text) // 4) AS tokens, row_number() OVER (ORDER BY (source <> 'src7')::INT, (lang <> 'de')::INT, doc_id) AS rank FROM documents QUALIFY rank <= 20)"


@query(f"WITH {_RANKED} SELECT doc_id, CAST(tokens AS BIGINT) AS tokens, rank FROM k")
def q_relevance_topk(spark, d):
    return _ranked(spark, d).select("doc_id", "tokens", long("rank"))


@query(f"""WITH RECURSIVE {_RANKED}, f AS (SELECT 1 AS rank, (SELECT CAST(tokens AS BIGINT) FROM k WHERE rank = 1) AS used, true AS accepted
  UNION ALL SELECT f.rank + 1, f.used + CASE WHEN f.used + k.tokens <= 4000 THEN k.tokens ELSE 0 END, f.used + k.tokens <= 4000 FROM f JOIN k ON k.rank = f.rank + 1)
  SELECT CAST(k.rank AS BIGINT) AS rank, CAST(tokens AS BIGINT) AS size, doc_id, accepted FROM f JOIN k ON k.rank = f.rank""")
def q_token_budget(spark, d):
    return rank.within_budget(_ranked(spark, d), F.col("tokens"), 4000, "doc_id").select(long("rank"), "size", "doc_id", "accepted")


@query("SELECT conv_id, turn, role, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS anchor FROM conversations")
def q_asof_anchor(spark, d):
    c = table(spark, d, "conversations", "conv_id", "turn", "role")
    return c.withColumn("anchor", anchor.anchor_in_force(c, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("turn"))))


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey AS anchor, l_suppkey AS item, l_linestatus = 'O' AS b FROM lineitem),
  t AS (SELECT DISTINCT p_partkey AS anchor, s AS item, p_size % 2 = 0 AS b FROM part, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10]) AS s) WHERE p_partkey % 10 < s)
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CASE WHEN x.item IS NOT NULL THEN 'ok' WHEN y.item IS NOT NULL THEN 'swapped' ELSE 'fabricated' END AS rule
  FROM c LEFT JOIN t x ON x.anchor = c.anchor AND x.item = c.item AND x.b = c.b LEFT JOIN t y ON y.anchor = c.anchor AND y.item = c.item AND y.b <> c.b""")
def q_claim_class(spark, d):
    claimed = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus").select("l_orderkey", long("l_linenumber"), F.col("l_partkey").alias("anchor"), F.col("l_suppkey").alias("item"), (F.col("l_linestatus") == "O").alias("claims_binding"))
    truth = table(spark, d, "part", "p_partkey", "p_size").select(F.col("p_partkey").alias("anchor"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(10).cast("long"))).alias("item"), (F.col("p_size") % 2 == 0).alias("binding")).where("anchor % 10 < item")
    judged = anchor.classify_claims(claimed, truth, "anchor", "item", "binding")
    # a line without a part claims what none holds
    return judged.select("l_orderkey", "l_linenumber", F.when(F.col("rule") == "no-anchor", "fabricated").otherwise(F.col("rule")).alias("rule"))


@query("""WITH s AS (SELECT event_id, user_id, ts, event_type, value, CAST(sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS scope FROM events)
  SELECT event_id, scope, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, scope ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS stem FROM s""")
def q_scope_carry(spark, d):
    e = table(spark, d, "events", "event_id", "user_id", "ts", "event_type")
    e = e.withColumn("scope", rank.scope_id(["user_id"], ["ts", "event_id"], F.col("event_type") == "error"))
    return e.select("event_id", "scope", rank.carried(F.when(F.col("event_type") == "signup", F.col("event_id")), ["user_id", "scope"], ["ts", "event_id"]).alias("stem"))


@query("SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS ordinal FROM orders")
def q_ordinals(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return o.select("o_orderkey", "o_custkey", rank.ordinal(["o_custkey", "o_orderpriority"], "o_orderdate", "o_orderkey").cast("long").alias("ordinal"))


@query("""SELECT doc_id FROM documents d JOIN labels l USING (doc_id) WHERE (quality IS NULL OR quality = 1) AND (lang = 'en' OR lang = 'de')""")
def q_rubric_filter(spark, d):
    joined = table(spark, d, "documents", "doc_id", "lang").join(table(spark, d, "labels", "doc_id", "quality"), "doc_id")
    tags = F.concat_ws("; ", F.concat(F.lit("quality="), F.col("quality").cast("string")), F.concat(F.lit("lang="), F.col("lang")))
    return joined.where(rank.applicable(tags, ["quality=1", "lang=en", "lang=de"])).select("doc_id")


@query("""SELECT lang, CAST(sum(strlen(text) + strlen(lang) + strlen(source)) AS BIGINT) AS repeated_bytes, CAST(sum(strlen(text)) + (SELECT sum(n) FROM (SELECT DISTINCT x.source, strlen(x.lang) + strlen(x.source) AS n FROM documents x WHERE x.lang = documents.lang)) AS BIGINT) AS shared_bytes FROM documents GROUP BY lang""")
def q_size_compare(spark, d):
    return index.shape_sizes(table(spark, d, "documents", "lang", "source", "text"), ["lang"], F.col("text"), "lang", "source")


from . import curriculum_queries as _more  # noqa: E402, F401  registers its queries with the same decorator
