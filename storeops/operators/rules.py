"""Data-quality rules as rows, compiled into one pass over all tables.

Each table is read once.  A row gives one entry per key a rule asks about, one that makes a key known where another table
refers to it, and one with the table's conditions.  The entries of all tables meet in one grouping by (slot, value): it
tells how often a key occurs and whether it is known, without a join and whatever the size of either side; a hot key shrinks
to one entry per task before it moves.  A second grouping by slot leaves one row per rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeops.functions.columns import big, dbl, literal_table, percent
from storeops.operators.quality import BLOCK, WARN, union_all

CONDITIONS = ("count", "share")
KEYS = ("unique", "reference", "optional_reference", "trend")
KINDS = (*CONDITIONS, *KEYS, "columns")
TREND_LOADS = 7  # earlier load days a load is compared with


@dataclass(frozen=True)
class Rule:
    """One row of the catalogue.  ``status`` is the severity when the value is above ``threshold``.

    kind                  subject                          value
    count                 condition                        rows that meet it
    share                 condition                        percent of rows that meet it
    unique                key                              keys that occur more than once; a null part counts as a value
    reference             key, target ``table.key``        rows whose key is null or not in the target
    optional_reference    key, target ``table.key``        rows whose key is given and not in the target
    trend                 day of load                      change of the last load against the mean of those before, in percent
    columns               columns with types, as in SQL    columns that are absent or have another type (reads no row)

    Conditions and keys are SQL expressions on the table; several parts of a key are separated by ``;``.  The parts of a
    reference need the type of the target's.
    """

    name: str
    severity: str
    kind: str
    table: str
    subject: str
    threshold: float = 0.0
    target: str | None = None


def read_rules(rows: DataFrame) -> list[Rule]:
    """Rules kept as a table (name, severity, kind, table, subject, threshold, target)."""
    return [Rule(**r.asDict()) for r in rows.select("name", "severity", "kind", "table", "subject", "threshold", "target").collect()]


def check_catalogue(rules: list[Rule], tables: dict[str, DataFrame]) -> None:
    """Refuses rules that could not be judged, so none is passed over in silence."""
    names = [r.name for r in rules]
    wrong = [f"{n}: given twice" for n in sorted({n for n in names if names.count(n) > 1})]
    for r in rules:
        if r.kind not in KINDS:
            wrong.append(f"{r.name}: kind {r.kind}")
        if r.severity not in (BLOCK, WARN):
            wrong.append(f"{r.name}: severity {r.severity}")
        if r.table not in tables:
            wrong.append(f"{r.name}: table {r.table}")
        if r.kind.endswith("reference") and (not r.target or r.target.partition(".")[0] not in tables):
            wrong.append(f"{r.name}: target {r.target}")
    if wrong:
        raise ValueError("; ".join(wrong))


def _key(subject: str, whole: bool) -> Column:
    """A key as text; ``whole``: null when a part is null."""
    parts = [F.expr(p).cast("string") for p in subject.split(";")]
    if len(parts) == 1:
        return parts[0]
    text = F.to_json(F.array(*parts))
    if not whole:
        return text
    filled = parts[0].isNotNull()
    for p in parts[1:]:
        filled = filled & p.isNotNull()
    return F.when(filled, text)


def _absent(rule: Rule, df: DataFrame) -> int:
    want = T._parse_datatype_string(rule.subject).fields
    have = {f.name: f.dataType for f in df.schema.fields}
    return sum(have.get(f.name) != f.dataType for f in want)


def compile_rules(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """check_name, severity, kind, table_name, row_count, bad, value, threshold, status: one row per rule.

    An empty table has no bad rows; a trend without an earlier load has no value and passes.
    """
    check_catalogue(rules, tables)
    spark = next(iter(tables.values())).sparkSession
    order = list(tables)
    conditions = {t: [r for r in rules if r.table == t and r.kind in CONDITIONS] for t in order}
    width = max([1, *[len(c) for c in conditions.values()]])
    slot_of = {r.name: i for i, r in enumerate(rules) if r.kind in KEYS}
    # a row gives as few entries as it can: a trend counts the entries of a reference of the same key, and the conditions of a
    # table ride on the entries of its first key, of which every row gives one
    for r in rules:
        if r.kind == "trend":
            alike = [x.name for x in rules if x.kind.endswith("reference") and (x.table, x.subject) == (r.table, r.subject)]
            slot_of[r.name] = slot_of[alike[0]] if alike else slot_of[r.name]
    table_slot = {t: next((slot_of[r.name] for r in rules if r.table == t and r.kind in KEYS), len(rules) + i) for i, t in enumerate(order)}

    def entry(slot: int, value: Column, n: int, known: bool, hits: list[Column]) -> Column:
        filled = [F.when(h, 1).otherwise(0).cast("long") for h in hits] + [F.lit(0).cast("long")] * (width - len(hits))
        return F.struct(
            F.lit(slot).alias("slot"), value.alias("value"), F.lit(n).cast("long").alias("n"), F.lit(known).alias("known"),
            *[h.alias(f"h{i}") for i, h in enumerate(filled)],
        )

    parts = []
    for t in order:
        hits = [F.expr(r.subject) for r in conditions[t]]
        own = {slot_of[r.name]: _key(r.subject, r.kind != "unique") for r in rules if r.table == t and r.kind in KEYS}
        if hits:
            own = own or {table_slot[t]: F.lit(None).cast("string")}
        entries = [entry(slot, value, 1, False, hits if slot == table_slot[t] else []) for slot, value in own.items()]
        for r in rules:
            if r.kind.endswith("reference") and r.target.partition(".")[0] == t:
                entries.append(entry(slot_of[r.name], _key(r.target.partition(".")[2], True), 0, True, []))
        if entries:
            parts.append(tables[t].select(F.inline(F.array(*entries))))

    catalogue = literal_table(spark, [
        (i, r.name, r.severity, r.kind, r.table, float(r.threshold), slot_of.get(r.name, table_slot[r.table]),
         conditions[r.table].index(r) if r.kind in CONDITIONS else 0, _absent(r, tables[r.table]) if r.kind == "columns" else 0)
        for i, r in enumerate(rules)
    ], ["_i", "check_name", "severity", "kind", "table_name", "threshold", "slot", "_hit", "_absent"])
    found = _by_slot(union_all(parts), sorted({slot_of[r.name] for r in rules if r.kind == "trend"}), width) if parts else None
    return _judged(catalogue, found, width)


def _by_slot(entries: DataFrame, trends: list[int], width: int) -> DataFrame:
    hits = [f"h{i}" for i in range(width)]
    usage = entries.groupBy("slot", "value").agg(F.sum("n").alias("n"), F.max("known").alias("known"), *[F.sum(h).alias(h) for h in hits])
    used = F.col("n") > 0
    null = F.col("value").isNull()
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    loads = F.collect_list(F.when(F.col("slot").isin(trends) & ~null & used, F.struct("value", "n"))) if trends else F.array().cast("array<struct<value:string,n:bigint>>")
    return usage.groupBy("slot").agg(
        F.sum("n").alias("row_count"), F.count_if(used & (F.col("n") > 1)).alias("repeated"),
        count(null).alias("nulls"), count(~null & ~F.col("known")).alias("unknown"),
        loads.alias("loads"), *[F.sum(h).alias(h) for h in hits],  # loads: one entry per load day
    )


def _judged(catalogue: DataFrame, found: DataFrame | None, width: int) -> DataFrame:
    if found is None:
        hits = ", ".join(f"cast(null as bigint) as h{i}" for i in range(width))
        found = catalogue.sparkSession.range(0).selectExpr(
            "cast(id as int) as slot", "id as row_count", "id as repeated", "id as nulls", "id as unknown",
            "cast(null as array<struct<value:string,n:bigint>>) as loads", *hits.split(", "))
    rows = catalogue.join(F.broadcast(found), "slot", "left")  # one row per rule and table
    kind = F.col("kind")
    hit = F.element_at(F.array(*[F.col(f"h{i}") for i in range(width)]), F.col("_hit") + 1)
    bad = (
        F.when(kind.isin(*CONDITIONS), hit).when(kind == "unique", F.col("repeated")).when(kind == "reference", F.col("nulls") + F.col("unknown"))
        .when(kind == "optional_reference", F.col("unknown")).when(kind == "columns", F.col("_absent"))
    )
    latest = F.sort_array("loads", False)
    before = F.slice(latest, 2, TREND_LOADS)
    mean = F.aggregate(before, F.lit(0).cast("long"), lambda a, x: a + x["n"]).cast("double") / F.nullif(F.size(before), F.lit(0))
    change = F.round(F.abs(F.get(latest, F.lit(0))["n"] - mean) * 100.0 / mean, 4)
    value = F.when(kind == "share", percent(bad, F.col("row_count"), 4)).when(kind == "trend", change).otherwise(dbl(F.coalesce(bad, F.lit(0))))
    return rows.withColumn("value", value).select(
        "check_name", "severity", "kind", "table_name", F.when(kind != "columns", big(F.coalesce("row_count", F.lit(0)))).alias("row_count"),
        F.when(kind != "trend", big(F.coalesce(bad, F.lit(0)))).alias("bad"), "value", "threshold",
        F.when(F.col("value") > F.col("threshold"), F.col("severity")).otherwise("PASS").alias("status"),
    )
