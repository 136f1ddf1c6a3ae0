"""Column resolution and conformance: vendor names -> target columns, text -> types.

Name handling works on the feed's column *vocabulary* (an ordered list of raw
names, bounded by the schema width, never by the data), so the per-row work is a
single ``select`` that codegen compiles: no per-row map rebuilding, no UDF.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.coerce import coerce, needs_double, to_double, violation_of
from tidemark.functions.text import clean_text, flag_normalize, strip
from tidemark.spec import FLAG_ADD, TableSpec, norm_name



def qcol(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass
class ColumnPlan:
    """How a feed's raw column names map onto a target table."""

    raw: list[str]                       # raw names, feed order
    kept: list[tuple[str, str]]          # (raw, resolved) after renames, trim+lower, first-wins
    extra: list[str] = field(default_factory=list)           # resolved names not in the target (flag excluded)
    missing: list[str] = field(default_factory=list)         # target names the feed lacks
    present: list[str] = field(default_factory=list)         # target names the feed has, target order
    has_flag: bool = False

    @property
    def resolved(self) -> list[str]:
        return [r for _, r in self.kept]

    def raw_for(self, resolved: str) -> str:
        return dict((r, s) for s, r in self.kept)[resolved]


def resolve_columns(raw_names: list[str], spec: TableSpec) -> ColumnPlan:
    """The target name of each raw name, the first of equal target names kept.

    A vendor name takes its target name from the table's renames; where one vendor
    name comes in several spellings, only the last of them is renamed."""
    spelling = {norm_name(raw): raw for raw in raw_names}
    kept: dict[str, str] = {}
    for raw in raw_names:
        name = norm_name(raw)
        if spelling[name] == raw:
            name = spec.renames.get(name, name)
        kept.setdefault(name, raw)
    target = spec.columns
    return ColumnPlan(
        raw=list(raw_names),
        kept=[(raw, name) for name, raw in kept.items()],
        extra=sorted(set(kept) - set(target) - {"flag"}),
        missing=sorted(set(target) - set(kept)),
        present=[c for c in target if c in kept],
        has_flag="flag" in kept,
    )


def _norm(raw: Column) -> Column:
    """``norm_name`` as an expression: white space of every kind is trimmed."""
    return F.lower(strip(raw))


def _shapes(records: DataFrame, rec: str, *aggs: Column) -> DataFrame:
    """The distinct key lists of the records: feeds repeat a few, which collapse map-side."""
    return records.groupBy(F.map_keys(F.col(rec)).alias("ks")).agg(F.count(F.lit(1)).alias("n"), *aggs)


def raw_columns(records: DataFrame, rec: str = "rec") -> DataFrame:
    """raw_name, records, place (its usual place in a record): every key the records carry."""
    return (_shapes(records, rec).select("n", F.posexplode("ks").alias("i", "raw_name"))
            .groupBy("raw_name").agg(F.sum("n").alias("records"), F.min("i").alias("place")))


def _first_seen(records: DataFrame, rec: str, pos: str) -> DataFrame:
    """raw_name, first: where each key appears first."""
    return (_shapes(records, rec, F.min(F.col(pos)).alias("p")).select("p", F.posexplode("ks").alias("i", "raw_name"))
            .groupBy("raw_name").agg(F.min(F.struct("p", "i")).alias("first")))


def record_vocabulary(records: DataFrame, spec: TableSpec, rec: str = "rec", pos: str = "pos") -> tuple[list[str], dict[str, int]]:
    """The raw names that stand for the target's columns (and ``flag``), in order of
    first appearance where that matters, and each one's usual place in a record.

    Per normalised name the first and the last spelling are kept, so what reaches the
    driver is bounded by the spec, whatever other keys the feed carries.  Only names
    that come in several spellings are traced to their first record."""
    wanted = sorted({*spec.columns, "flag", *spec.renames})
    named = raw_columns(records, rec).withColumn("name", _norm(F.col("raw_name"))).where(F.col("name").isin(wanted))
    rows = named.groupBy("name").agg(F.min("raw_name").alias("a"), F.max("raw_name").alias("z"), F.min("place").alias("i")).orderBy("i", "name").collect()
    single = [(r["a"], int(r["i"])) for r in rows if r["a"] == r["z"]]
    several = [r["name"] for r in rows if r["a"] != r["z"]]
    # a vendor name and its target name are one column too: their order counts
    targets = {t for n, t in spec.renames.items() for r in rows if r["name"] == n}
    several += [r["name"] for r in rows if r["a"] == r["z"] and (r["name"] in targets or spec.renames.get(r["name"]) in {x["name"] for x in rows})]
    if several:
        single = [(raw, i) for raw, i in single if norm_name(raw) not in several]
        seen = _first_seen(records, rec, pos).withColumn("name", _norm(F.col("raw_name"))).where(F.col("name").isin(several))
        ends = seen.groupBy("name").agg(F.min_by(F.struct("raw_name", "first"), "first").alias("a"), F.max_by(F.struct("raw_name", "first"), "first").alias("z"))
        found = ends.select(F.explode(F.array_distinct(F.array("a", "z"))).alias("x")).select("x.*").orderBy("first").collect()
        single += [(r["raw_name"], int(r["first"]["i"])) for r in found]
    return [raw for raw, _ in single], dict(single)


def conform(df: DataFrame, spec: TableSpec, plan: ColumnPlan, rec: str | None = None,
            pos: str | None = "pos", on_fraction: str = "fail", require_flag: bool = False,
            default_flag: str = FLAG_ADD, violations: bool = True,
            key_index: dict[str, int] | None = None) -> DataFrame:
    """Project a feed onto the target: present target columns (target order), typed,
    then ``flag``, then the order column, then ``_bad`` (columns whose present
    value cannot be stored in the declared type).

    ``rec`` names a map<string,string> column holding the records; when None the
    feed's own columns are used.  ``key_index`` gives, per raw key, its usual
    position in a record: the key at that position is checked first (one
    comparison), and the map is searched only when it differs, so wide records
    do not pay a map scan per column.
    """
    if not plan.present and not plan.has_flag:
        raise ValueError(f"No valid columns after schema filtering for table={spec.name}")
    if require_flag and not plan.has_flag:
        raise ValueError(f"Required 'flag' column not present for table: {spec.name}")

    def source(resolved: str) -> Column:
        raw = plan.raw_for(resolved)
        if rec is None:
            return qcol(raw)
        m = F.col(rec)
        if key_index is not None and raw in key_index:
            i = F.lit(key_index[raw] + 1)
            # try_element_at: a shorter record gives NULL, not an ANSI index error
            return F.when(F.try_element_at(F.map_keys(m), i) == F.lit(raw),
                          F.try_element_at(F.map_values(m), i)).otherwise(m.getItem(raw))
        return m.getItem(raw)

    def cleaned(resolved: str) -> Column:
        text = clean_text(source(resolved).cast("string"))
        # the bare token NaN of a JSON record arrives with quotes around it
        return text if rec is None else F.nullif(text, F.lit('"NaN"'))

    src_types = {} if rec is not None else {f.name: f.dataType for f in df.schema.fields}
    # Four projections, each value computed once: (1) cleaned text, (2) text
    # parsed as a number, (3) declared type, (4) violations from the columns of
    # (1)-(3).  Spark keeps them apart because later stages use earlier columns
    # several times, which keeps the generated code of wide feeds small.
    stage1, stage2, stage3, bad = [], [], [], []
    carry = []
    for i, c in enumerate(plan.present):
        if c == "flag":
            continue
        dtype = spec.dtype(c)
        raw = plan.raw_for(c)
        if rec is None and src_types.get(raw) == dtype:
            if dtype.simpleString() == "string":
                stage1.append(clean_text(source(c)).alias(f"_v{i}"))
                if c in spec.lengths:
                    bad.append(F.when(F.coalesce(F.char_length(F.col(c)) > F.lit(spec.lengths[c]),
                                                 F.lit(False)), F.lit(c)))
            else:
                stage1.append(source(c).alias(f"_v{i}"))
            stage2.append(F.col(f"_v{i}"))
            stage3.append(F.col(f"_v{i}").alias(c))
            continue
        stage1.append(cleaned(c).alias(f"_s{i}"))
        stage2.append(F.col(f"_s{i}"))
        d = None
        if needs_double(dtype):
            stage2.append(to_double(F.col(f"_s{i}")).alias(f"_d{i}"))
            d = F.col(f"_d{i}")
        value, _ = coerce(F.col(f"_s{i}"), dtype, on_fraction, None, cleaned=True, d=d)
        stage3.append(value.alias(c))
        violation = violation_of(dtype, F.col(f"_s{i}"), d, F.col(c), on_fraction, spec.lengths.get(c))
        if violation is not None:
            carry += [f"_s{i}"] + ([f"_d{i}"] if d is not None else [])
            bad.append(F.when(violation, F.lit(c)))
    flag = flag_normalize(source("flag")) if plan.has_flag else F.lit(default_flag)
    keep = [flag.alias("flag")] + ([F.col(pos).alias("pos")] if pos is not None else [])
    tail = ["flag"] + (["pos"] if pos is not None else [])
    s1 = df.select(*stage1, *keep)
    s2 = s1.select(*stage2, *tail)
    s3 = s2.select(*stage3, *tail, *[F.col(x) for x in dict.fromkeys(carry)])
    out = [F.col(f.name) for f in s3.schema.fields if f.name in [c for c in plan.present if c != "flag"]]
    out += [F.col("flag")] + ([F.col("pos")] if pos is not None else [])
    if violations:
        out.append((F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")).alias("_bad"))
    return s3.select(*out)


def observed_columns(records: DataFrame, spec: TableSpec, rec: str = "rec", pos: str = "pos") -> DataFrame:
    """(table_name, raw_name, column_name, records): every key the records carry,
    resolved like :func:`resolve_columns` does, with the number of records carrying it.
    A distributed aggregate, so a feed may carry any number of unknown keys."""
    names = raw_columns(records, rec).withColumn("norm", _norm(F.col("raw_name")))
    resolved = F.col("norm")
    if spec.renames:
        m = F.create_map(*[x for kv in spec.renames.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        last = (_first_seen(records, rec, pos).withColumn("norm", _norm(F.col("raw_name"))).where(F.col("norm").isin(sorted(spec.renames)))
                .groupBy("norm").agg(F.max_by("raw_name", "first").alias("last")))
        names = names.join(F.broadcast(last), "norm", "left")
        resolved = F.when(F.col("raw_name") == F.col("last"), F.element_at(m, F.col("norm"))).otherwise(F.col("norm"))
    return names.select(F.lit(spec.name.lower()).alias("table_name"), "raw_name", resolved.alias("column_name"), "records")
