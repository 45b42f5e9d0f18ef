"""Raw text rows to typed rows that carry their verdict.

Every source row comes out exactly once, with ``reject_reason`` NULL (accepted) or naming the
first rule it breaks, and with ``issues`` listing the cells that were nulled or cut. Accepted
rows, rejects and reports are all read from this one frame.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.cleaning import null_if_token
from ..functions.dates import date_attributes, date_key
from ..functions.results import full_name, result_flags
from ..functions.typed import collect_issues, is_lost, issue_of, typed_value
from ..operators.keys import first_rows, mark_first
from ..operators.lookups import mark_parent
from ..schemas import DIM_DATE, DIM_DRIVER, FACT_RACE_RESULT, Field, ForeignKey, TableSpec
from ..sources.text import BAD_LINE, ORDER

REASON = "reject_reason"
ISSUES = "issues"
SOURCE_KEY = "source_key"
FAULT = "_fault"
VERDICT_COLUMNS = (REASON, ISSUES, SOURCE_KEY, BAD_LINE)

Parents = Mapping[str, DataFrame | Column]


def _text(field: Field) -> Column:
    return F.col(f"_text_{field.name}")


def _parsed(raw: DataFrame, fields: list[Field], keys: list[Field] | None = None) -> DataFrame:
    """Typed columns next to their cleaned text: each cell is cleaned and parsed once.

    ``keys`` are the fields that conditions will be put on. They are made by a generator of one row,
    which Spark moves no condition through: a condition on a projected column is moved below it with the
    whole expression in each place, so the cell is parsed again and again, in one method too long for
    the JVM to compile.
    """
    keys = keys or []
    if BAD_LINE not in raw.columns:
        raw = raw.withColumn(BAD_LINE, F.lit(None).cast("string"))
    cells = raw.select(
        *[null_if_token(f.source).alias(f"_text_{f.name}") for f in fields], BAD_LINE, ORDER)
    typed = {f.name: typed_value(_text(f), f).alias(f.name) for f in fields}
    made_keys = [F.inline(F.array(F.struct(*[typed[f.name] for f in keys])))] if keys else []
    return cells.select("*", *made_keys, *[typed[f.name] for f in fields if f not in keys])


def _issues(fields: list[Field]) -> dict[str, tuple[str, Column]]:
    found = {f.name: issue_of(_text(f), F.col(f.name), f) for f in fields}
    return {name: issue for name, issue in found.items() if issue}


def typed_rows(raw: DataFrame, spec: TableSpec, extra: tuple[Field, ...] = ()) -> DataFrame:
    """Declared columns in their types, plus issues, the raw text of a bad key, and order.

    ``raw`` is source text, with or without its null tokens.
    """
    fields = [*spec.source_fields, *extra]
    keys = [f for f in spec.source_fields if f.name in spec.required]
    bad_key = F.lit(False)
    for f in keys:
        bad_key = bad_key | is_lost(_text(f), F.col(f.name))
    key_text = F.concat_ws("|", *[F.coalesce(_text(f), F.lit("")) for f in keys])
    return _parsed(raw, fields, keys).select(
        *[f.name for f in fields],
        collect_issues(_issues(fields)).alias(ISSUES),
        F.when(bad_key, key_text).alias(SOURCE_KEY),
        BAD_LINE, ORDER,
    )


def cast_report(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Cells of source text that typing would null or cut, per column, in one aggregate."""
    issues = _issues(spec.source_fields)
    totals = _parsed(raw, spec.source_fields).agg(*[
        F.count_if(found).alias(name) for name, (_, found) in issues.items()])
    lines = F.array(*[
        F.struct(
            F.lit(spec.name).alias("table_name"), F.lit(name).alias("column_name"),
            F.lit(action).alias("action"), F.col(name).alias("n_rows"))
        for name, (action, _) in issues.items()
    ])
    return totals.select(F.inline(lines)).where("n_rows > 0")


def _known(fk: ForeignKey) -> str:
    return f"_known_{fk.column}"


def own_fault() -> Column:
    """The first rule that a row which is not sound breaks by itself. Each outcome is a constant, so that
    a condition on the outcome is settled when the query is planned."""
    return (
        F.when(F.col(BAD_LINE).isNotNull(), F.lit("malformed_row"))
        .when(F.col(SOURCE_KEY).isNotNull(), F.lit("bad_key"))
        .otherwise(F.lit("null_key"))
    )


def _is_sound(typed: DataFrame, spec: TableSpec) -> Column:
    """Does the row break no rule by itself, without a look at any other row?

    A bad key is a key column without a value, so the text of the keys need not be looked at again.
    """
    sound = F.col(BAD_LINE).isNull()
    for name in spec.required:
        if name in typed.columns:
            sound = sound & F.col(name).isNotNull()
    return sound


def _sound(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows without a fault of their own, which have neither a bad line nor a bad key to tell of."""
    none = F.lit(None).cast("string")
    return typed.where(_is_sound(typed, spec)).withColumns({SOURCE_KEY: none, BAD_LINE: none})


def _with_parents(rows: DataFrame, spec: TableSpec, parents: Parents) -> DataFrame:
    """Rows all of whose foreign keys are known."""
    for fk in spec.foreign_keys:
        rows = mark_parent(rows, parents[fk.parent], fk.column, _known(fk)).where(_known(fk)).drop(_known(fk))
    return rows


def accepted_keys(typed: DataFrame, spec: TableSpec, parents: Parents | None = None) -> DataFrame:
    """Keys that the table will hold: those of any sound row (which row wins does not matter)."""
    return _with_parents(_sound(typed, spec), spec, parents or {}).select(*spec.key).distinct()


def accepted_rows(typed: DataFrame, spec: TableSpec, parents: Parents | None = None) -> DataFrame:
    """The rows that a dimension will hold, for readers that need no rejects: one window over the
    sound rows."""
    rows = _finished(_with_parents(_sound(typed, spec), spec, parents or {}), spec)
    return first_rows(rows, spec.key, [ORDER]).select(*spec.columns)


def annotate(typed: DataFrame, spec: TableSpec, parents: Parents,
             lookup: DataFrame | None = None, broken: bool = True) -> DataFrame:
    """Apply not-null, foreign-key and primary-key rules; foreign keys come first.

    Rows that are broken by themselves take part in no join: they are read once more and
    added at the end (not at all if ``broken`` is off). So no join meets a NULL key, which a
    third of the rows may share.

    A row that breaks a foreign key never takes the primary key. Rules that depend on the
    key alone (a foreign key inside it, or on ``lookup`` columns joined by it) hold for all
    rows of a key alike, so only the other foreign keys decide who competes for a key, on
    narrow rows. Rules on lookup columns run on the lookup, which has one row per key and
    tells in its FAULT column why a key is unusable. Foreign keys whose parent is not given
    are settled by the lookup.

    ``typed`` is read more than once and its order column must be the same each time: pass
    a written table, or rows ordered by stored columns.
    """
    fks = [fk for fk in spec.foreign_keys if fk.parent in parents]
    on_lookup = [fk for fk in fks if lookup is not None and fk.column in lookup.columns]
    on_key = [fk for fk in fks if fk.column in spec.key and fk not in on_lookup]
    others = [fk for fk in fks if fk not in [*on_lookup, *on_key]]
    sound = frame = _sound(typed, spec)
    candidates = sound.select(*dict.fromkeys([*spec.key, *[fk.column for fk in others]]), ORDER)
    for fk in others:
        candidates = mark_parent(candidates, parents[fk.parent], fk.column, _known(fk)).where(_known(fk))
        frame = mark_parent(frame, parents[fk.parent], fk.column, _known(fk))
    frame = mark_first(frame, candidates, spec.key, ORDER, "_is_first")
    steps = []
    if lookup is not None:
        shared = [name for name in lookup.columns if name in typed.columns]
        for fk in on_lookup:
            lookup = mark_parent(lookup, parents[fk.parent], fk.column, _known(fk))
        frame = frame.join(lookup.withColumn("_found", F.lit(True)), shared, "left")
        absent = next(fk.reason for fk in spec.foreign_keys if fk.column in shared)
        steps += [F.when(F.col("_found").isNull(), F.lit(absent)), F.col(FAULT)]
    for fk in on_key:
        frame = mark_parent(frame, parents[fk.parent], fk.column, _known(fk))
    steps += [F.when(~F.col(_known(fk)), F.lit(fk.reason)) for fk in fks]
    steps += [F.when(~F.col("_is_first"), F.lit("duplicate_key"))]
    frame = frame.withColumn(REASON, F.coalesce(*steps)).drop("_is_first", "_found", FAULT, *[_known(fk) for fk in fks])
    if broken:
        rest = typed.where(~_is_sound(typed, spec)).withColumn(REASON, own_fault())
        frame = frame.unionByName(rest, allowMissingColumns=True)
    return frame


def _finished(frame: DataFrame, spec: TableSpec) -> DataFrame:
    """With the columns that are derived after typing; what is cut there counts as an issue."""
    if spec is not DIM_DRIVER:
        return frame
    length = next(f.length for f in spec.fields if f.name == "full_name")
    whole = full_name(F.col("first_name"), F.col("last_name"))
    more = F.concat(F.coalesce(ISSUES, F.array().cast("array<string>")), F.array(F.lit("full_name:cut")))
    return frame.withColumns({
        "full_name": F.substring(whole, 1, length),
        ISSUES: F.when(F.length(whole) > length, more).otherwise(F.col(ISSUES)),
    })


def annotate_dimension(typed: DataFrame, spec: TableSpec, parents: Parents | None = None) -> DataFrame:
    """One dimension's typed rows with their verdict."""
    frame = _finished(annotate(typed, spec, parents or {}), spec)
    return frame.select(*spec.columns, *VERDICT_COLUMNS, ORDER)


def date_dimension(typed_races: DataFrame) -> DataFrame:
    """One row per distinct race date, with every calendar attribute."""
    sound = F.col("date").isNotNull() & F.col(BAD_LINE).isNull()
    dates = typed_races.where(sound).select("date").distinct()
    return dates.select(*[c.alias(n) for n, c in date_attributes(F.col("date")).items()]).select(*DIM_DATE.columns)


def race_lookup(typed_races: DataFrame, circuits: DataFrame) -> DataFrame:
    """race_id to circuit, date and FAULT, one row per race; ``circuits`` holds the known ids.

    Of several source rows for a race, the first one with a known circuit and a date counts,
    because a result joined to any of the others would be rejected. FAULT says why no row of
    a race is usable, by the first of them; a race whose circuit is unknown is no race.
    """
    rows = typed_races.where(F.col("race_id").isNotNull() & F.col(BAD_LINE).isNull())
    rows = mark_parent(rows, circuits, "circuit_id", "_known")
    unreadable = F.array_contains(F.coalesce(ISSUES, F.array().cast("array<string>")), "date:nulled")
    fault = (
        F.when(F.col("circuit_id").isNull(), F.lit("race_without_circuit"))
        .when(~F.col("_known"), F.lit("missing_race"))
        .when(F.col("date").isNull() & unreadable, F.lit("race_with_bad_date"))
        .when(F.col("date").isNull(), F.lit("race_without_date"))
    )
    rows = rows.withColumn(FAULT, fault).withColumn("_unusable", F.col(FAULT).isNotNull())
    firsts = first_rows(rows, ["race_id"], ["_unusable", ORDER])
    return firsts.select("race_id", "circuit_id", date_key(F.col("date")).alias("date_id"), FAULT)


def typed_results(raw: DataFrame) -> DataFrame:
    """Typed race results, with the status that the fact itself does not keep."""
    return typed_rows(raw, FACT_RACE_RESULT, (Field("status_id", "int", "statusId"),))


def annotate_fact(typed: DataFrame, races: DataFrame, parents: Parents, broken: bool = True) -> DataFrame:
    """Typed race results with circuit, date, flags and verdict. ``races`` is a race_lookup, which
    settles the keys of races and circuits."""
    parents = {name: parents[name] for name in ("dim_driver", "dim_constructor", "dim_date")}
    frame = annotate(typed, FACT_RACE_RESULT, parents, races, broken)
    flags = result_flags(F.col("finish_pos"), F.col("grid_pos"), F.col("points"), F.col("status_id"))
    return frame.withColumns(flags).select(*FACT_RACE_RESULT.columns, *VERDICT_COLUMNS, ORDER)


def reject_reasons(spec: TableSpec) -> list[str]:
    """Every reason that a row of the table can be rejected for."""
    reasons = ["malformed_row", "bad_key", "null_key", *[fk.reason for fk in spec.foreign_keys], "duplicate_key"]
    if spec is FACT_RACE_RESULT:
        reasons += ["race_without_circuit", "race_with_bad_date", "race_without_date"]
    return reasons


def observed_outcomes(annotated: DataFrame, spec: TableSpec) -> tuple[DataFrame, Observation]:
    """The same rows, counted by outcome while they are written.

    Put the write behind it without another shuffle in between: the rows of the last stage count once,
    however often one of its tasks is tried, while an earlier stage may run twice.
    """
    observation = Observation()
    reason = F.col(REASON)
    counts = [F.count("*").alias("extracted"), F.count_if(reason.isNull()).alias("accepted")]
    counts += [F.count_if(reason == name).alias(name) for name in reject_reasons(spec)]
    return annotated.observe(observation, *counts), observation


def outcomes_of(observation: Observation) -> dict[str, int]:
    """Rows per outcome, without those that no row has; all of them are ``extracted``."""
    found = observation.get
    return {name: n for name, n in found.items() if n or name == "extracted"}


def accepted(annotated: DataFrame, spec: TableSpec) -> DataFrame:
    return annotated.where(F.col(REASON).isNull()).select(*spec.columns)


def rejected(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col(REASON).isNotNull())


def outcome_counts(annotated: DataFrame, table: str) -> DataFrame:
    """Rows per outcome of one table: 'accepted' or the reject reason."""
    outcome = F.coalesce(F.col(REASON), F.lit("accepted"))
    return (
        annotated.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n_rows"))
        .select(F.lit(table).alias("table_name"), "outcome", "n_rows")
    )


def issue_counts(annotated: DataFrame, table: str) -> DataFrame:
    """Cells nulled or cut, per column of a written table with its verdicts."""
    return (
        annotated.select(F.explode(ISSUES).alias("issue"))
        .groupBy("issue").agg(F.count("*").alias("n_rows"))
        .select(
            F.lit(table).alias("table_name"),
            F.split_part("issue", F.lit(":"), F.lit(1)).alias("column_name"),
            F.split_part("issue", F.lit(":"), F.lit(2)).alias("action"),
            "n_rows",
        )
    )
