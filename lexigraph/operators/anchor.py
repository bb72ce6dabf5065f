"""Citation anchoring: walking block trees, the anchor in force, and claims."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

CLAIM = r"(?i)verbindlich|optional|allenfalls"


def walk(tree: object, path: str = "$") -> Iterator[tuple[str, dict]]:
    """Every object of a JSON tree with its path, parents first."""
    todo = [(path, tree)]
    while todo:
        at, node = todo.pop()
        if isinstance(node, dict):
            yield at, node
            todo.extend((f"{at}.{k}", v) for k, v in reversed(list(node.items())))
        elif isinstance(node, list):
            todo.extend((f"{at}[{i}]", v) for i, v in reversed(list(enumerate(node))))


def blocks(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, path, type, block): the objects of each JSON document in document order; null or broken documents give none."""

    def walked(batches):
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    tree = json.loads(t or "null")
                except ValueError:
                    continue
                for pos, (path, node) in enumerate(walk(tree)):
                    kind = node.get("type")
                    rows.append((k, pos, path, kind if isinstance(kind, str) else None, json.dumps(node, ensure_ascii=False)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()))], [key, "pos", "path", "type", "block"])

    return documents.select(F.col(key).cast("string").alias(key), text).mapInArrow(walked, f"{key} string, pos int, path string, type string, block string")


def anchor_in_force(rows: DataFrame, group: list[str], order: str, anchor: Column) -> Column:
    """The nearest anchor before a row in document order, or null."""
    return F.last(anchor, ignorenulls=True).over(Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))


def claims(rows: DataFrame, label: Column, item: Column) -> DataFrame:
    """Rows that claim an application item under a label of binding or choice."""
    return rows.where(label.rlike(CLAIM)).withColumn("claims_binding", label.rlike("(?i)verbindlich") & ~label.rlike("(?i)optional|allenfalls")).withColumn("claimed", item)


def classify_claims(claimed: DataFrame, truth: DataFrame, anchor: str, item: str, binding: str, document: str | None = None, anchors: DataFrame | None = None) -> DataFrame:
    """Adds rule: 'ok' if the anchor's items of the claimed binding hold the item, 'swapped' if those of the other
    binding do, 'fabricated' if neither.  A claim before its document's first anchor is held against all of the
    document's anchors, given as rows (document, anchor); without any it has 'no-anchor'."""
    if document and anchors is not None:
        every = anchors.select(document, F.col(anchor).alias("__other")).distinct()
        early = claimed.where(F.col(anchor).isNull()).withColumn("__row", F.struct(*claimed.columns)).join(every, document, "left")
        judged = _judged(early.withColumn(anchor, F.col("__other")), truth, anchor, item, binding)
        # the best verdict over the candidates: ok, then swapped, then fabricated
        order = F.when(F.col("rule") == "ok", 0).when(F.col("rule") == "swapped", 1).when(F.col("rule") == "fabricated", 2).otherwise(3)
        best = judged.groupBy("__row").agg(F.min_by("rule", order).alias("rule")).select("__row.*", "rule")
        return _judged(claimed.where(F.col(anchor).isNotNull()), truth, anchor, item, binding).unionByName(best)
    return _judged(claimed, truth, anchor, item, binding)


def _judged(claimed: DataFrame, truth: DataFrame, anchor: str, item: str, binding: str) -> DataFrame:
    held = F.col(binding)
    # a row for each anchor and item.  Its size isn't known before it is grouped, so it is never collected to be sent to all
    # tasks; most are there once, so they are dealt out before they are grouped
    known = truth.select(anchor, item, binding).repartition(anchor, item).groupBy(anchor, item).agg(F.bool_or(held).alias("__yes"), F.bool_or(~held).alias("__no")).hint("shuffle_merge")
    joined = claimed.join(known, [anchor, item], "left")
    claims, yes, no = F.col("claims_binding"), F.col("__yes"), F.col("__no")
    rule = F.when(F.col(anchor).isNull(), "no-anchor").when(claims & yes | ~claims & no, "ok").when(claims & no | ~claims & yes, "swapped").otherwise("fabricated")
    return joined.select(*claimed.columns, rule.alias("rule"))


def check_quotes(anchors: DataFrame, truth: DataFrame, key: str, *fields: str) -> DataFrame:
    """(key, pos, rule) where an anchor's key is unknown, or a quoted field differs from the record."""
    right = truth.select(F.col(key), *[F.col(f).alias(f"__{f}") for f in fields], F.lit(True).alias("__known"))
    joined = anchors.join(right, key, "left")
    wrong = F.filter(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"__{f}")), F.lit(f"{f}-differs")) for f in fields]), lambda x: x.isNotNull())
    rules = F.when(F.col("__known").isNull(), F.array(F.lit("unknown-anchor"))).otherwise(wrong)
    return joined.select(key, "pos", F.explode(rules).alias("rule"))


# fixed values: the rule codes of a lesson check
RULES = {"none": "kein-kompetenzbezug", "unknown": "id-unaufloesbar", "quote": "zitat-nicht-wortgetreu", "source": "provenienz-veraendert", "mixed": "verbindlich-optional-vermischt", "made_binding": "erfundenes-verbindliches-item", "made_optional": "erfundenes-optionales-item", "optional_as_binding": "optionales-item-als-verbindlich-ausgegeben", "binding_as_optional": "verbindliches-item-als-optional-ausgegeben"}


def violations(lessons: DataFrame, key: str, tree: str, records: DataFrame, items: DataFrame) -> DataFrame:
    """(key, path, rule, value) of lesson documents against records (id, volltext, provenienz as JSON) and items
    (kompetenz_id, text, verbindlich): anchors first, then the claims under the anchor in force."""
    b = blocks(lessons, key, tree)
    field = lambda path: F.get_json_object("block", f"$.{path}")
    b = b.withColumn("anchor", F.when(F.col("type") == "kompetenzbezug", field("kompetenz_id")))
    # all rules read the walk, which is made once
    b = staged(b.withColumn("in_force", anchor_in_force(b, [key], "pos", F.col("anchor"))), "blocks")
    anchors = b.where("type = 'kompetenzbezug'").select(key, "path", F.col("anchor").alias("id"), field("text").alias("quote"), field("quelle").alias("source"))
    held = anchors.join(records.select("id", "volltext", "provenienz"), "id", "left")
    row = lambda df, rule, value: df.select(key, "path", F.lit(RULES[rule]).alias("rule"), value.alias("value"))
    same_source = F.from_json("source", "map<string,string>")
    out = row(held.where("volltext is null"), "unknown", F.col("id"))
    out = out.unionByName(row(held.where("volltext is not null and not quote <=> volltext"), "quote", F.col("quote")))
    entries = lambda m: F.array_sort(F.filter(F.map_entries(m), lambda e: e["value"].isNotNull()))
    out = out.unionByName(row(held.where(F.col("volltext").isNotNull() & ~entries(same_source).eqNullSafe(entries(F.from_json("provenienz", "map<string,string>")))), "source", F.col("source")))
    none = lessons.select(F.col(key).cast("string").alias(key)).join(anchors.select(key), key, "left_anti").withColumn("path", F.lit("$"))
    out = out.unionByName(row(none, "none", F.lit(None).cast("string")))
    label = field("label")
    binding, choice = label.rlike("(?i)verbindlich"), label.rlike("(?i)optional|allenfalls")
    claimed = b.where(F.coalesce(binding | choice, F.lit(False))).withColumns({"both": binding & choice, "claims_binding": binding, "claimed": F.explode(F.from_json(field("items"), "array<string>"))})
    out = out.unionByName(row(claimed.where("both").select(key, "path").distinct(), "mixed", F.lit(None).cast("string")))
    truth = items.select(F.col("kompetenz_id").alias("in_force"), F.col("text").alias("claimed"), "verbindlich")
    judged = classify_claims(claimed.where("not both").select(key, "path", "in_force", "claimed", "claims_binding"), truth, "in_force", "claimed", "verbindlich", key, anchors.select(key, F.col("id").alias("in_force")))
    rule = F.when(F.col("rule") == "fabricated", F.when(F.col("claims_binding"), RULES["made_binding"]).otherwise(RULES["made_optional"])).when(F.col("rule") == "swapped", F.when(F.col("claims_binding"), RULES["optional_as_binding"]).otherwise(RULES["binding_as_optional"]))
    return out.unionByName(judged.select(key, "path", rule.alias("rule"), F.col("claimed").alias("value")).where("rule is not null"))
