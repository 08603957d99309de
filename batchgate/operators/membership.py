"""Rules about what history holds: unseen values, repeats, unseen combinations, duplicate keys.

All of them ask the same question, "does this key occur in history?", so they share one plan.
The keys of the batch and of history become rows ``(rule, k0, k1, ...)``; history is reduced to the
keys the batch asks for, and the batch joins that.  Several rules on one table therefore read it once.

At scale history is far larger than the batch.  ``distinct`` over history is combined map-side, so a
key holding a third of all rows leaves each task once; and where the batch keys are small enough to
broadcast, Catalyst moves the semi join below the ``distinct`` and history is filtered as it is
scanned.  The size decision is Spark's own, from table statistics: no hint is given here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.functions.keys import number_text
from batchgate.operators.joins import RULE_NO, splittable_on
from batchgate.operators.violations import VIOLATION_COLUMNS, Rule, as_violations, rule_columns
from batchgate.session import stage


@dataclass(frozen=True)
class KeyRule:
    """One membership rule.

    ``history`` names, per history table, the columns that pair with ``batch``.  ``unseen`` rules
    flag keys that history lacks, the others keys that it holds.  ``skip_nulls`` leaves out batch rows
    with a null key, ``required`` those where that one column is null.
    """

    rule: Rule
    batch: tuple[str, ...]
    history: Mapping[str, tuple[str, ...]]
    unseen: bool = True
    skip_nulls: bool = False
    required: str | None = None
    entity: str | None = None
    column: str | None = None

    @property
    def needed(self) -> tuple[str, ...]:
        """Batch columns that must be present for the rule to apply to a row."""
        if self.skip_nulls:
            return self.batch
        return (self.required,) if self.required else ()


def key_text(df: DataFrame, column: str) -> Column:
    """Text of a key column, so that ``18`` and ``18.0`` are the same key."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return number_text(c)
    return c.cast("string")


def long_keys(
    df: DataFrame,
    columns: Mapping[int, Sequence[str]],
    arity: int,
    carry: Mapping[int, Mapping[str, Column]] | None = None,
    needed: Mapping[int, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows ``(rule_no, k0.., carried columns)``: one per input row and rule, in one pass.

    ``needed`` columns that are null leave the row out for that rule.
    """
    needed = {no: names for no, names in (needed or {}).items() if names}
    structs = []
    for no, names in columns.items():
        keys = [key_text(df, n) for n in names]
        padded = keys + [F.lit(None).cast("string")] * (arity - len(keys))
        s = F.struct(
            F.lit(no).alias(RULE_NO),
            *[k.alias(f"k{i}") for i, k in enumerate(padded)],
            *[c.cast("string").alias(a) for a, c in (carry or {}).get(no, {}).items()],
        )
        if no in needed:
            s = F.when(reduce(lambda a, b: a & b, [F.col(f"`{n}`").isNotNull() for n in needed[no]]), s)
        structs.append(s)
    if len(structs) == 1:
        return df.select(structs[0].alias("x")).filter("x is not null").select("x.*")
    # Keys left out go after the explode: a function of an array's items is not compiled, nor are the keys inside it.
    rows = df.select(F.explode(F.array(*structs)).alias("x"))
    return (rows.filter("x is not null") if needed else rows).select("x.*")


def seen_keys(batch_keys: DataFrame, history_keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct history keys that the batch asks for.

    The key is one struct, null-safe as such, so that the shuffle that makes history distinct also
    serves the join.  Where that sorts, it sorts by the hash before it: a number needs no text compared.
    """
    key = [F.xxhash64(*columns).alias("hash"), F.struct(*columns).alias("key")]
    asked = batch_keys.select(*key).distinct()
    known = history_keys.select(*key).distinct()
    return known.join(asked, ["hash", "key"], "left_semi").select("key.*")


def check_keys(
    batch: DataFrame, history: Mapping[str, DataFrame], rules: Sequence[KeyRule], entry_file: str = "entry_file"
) -> DataFrame:
    """Evaluate all rules with one scan per table.  Returns violations, one per distinct key, entity and file."""
    arity = max(len(r.batch) for r in rules)
    keys = [RULE_NO, *[f"k{i}" for i in range(arity)]]
    carried = {
        no: {
            "entity": F.col(r.entity) if r.entity else F.lit(None),
            "entry_file": F.col(f"`{entry_file}`"),
        }
        for no, r in enumerate(rules)
    }
    needed = {no: r.needed for no, r in enumerate(rules)}
    asked = long_keys(batch, {no: r.batch for no, r in enumerate(rules)}, arity, carried, needed).distinct()

    sources = []
    for name, table in history.items():
        columns = {no: r.history[name] for no, r in enumerate(rules) if name in r.history}
        # Nobody asks for a null where the batch must have a value, so such history rows stay behind.
        present = {no: [h for h, b in zip(c, rules[no].batch, strict=True) if b in needed[no]] for no, c in columns.items()}
        if columns:
            sources.append(long_keys(table, columns, arity, needed=present))
    known = reduce(DataFrame.unionByName, sources)
    seen = seen_keys(asked, known, keys)

    unseen = [no for no, r in enumerate(rules) if r.unseen]
    same_key = splittable_on([asked[k] for k in keys], [seen[k] for k in keys])
    if len(unseen) == len(rules):
        flagged = asked.join(seen, same_key, "left_anti")
    elif not unseen:
        flagged = asked.join(seen, same_key, "left_semi")
    else:
        # Both kinds of rule: one join that keeps the answer, so that history is still read once.
        answered = asked.join(seen.withColumn("hit", F.lit(True)), same_key, "left")
        flagged = answered.filter(F.col("hit").isNull() == asked[RULE_NO].isin(unseen)).select(
            *[asked[c] for c in asked.columns]
        )
    return _describe(flagged, rules)


def _describe(flagged: DataFrame, rules: Sequence[KeyRule]) -> DataFrame:
    """Attach the identity of the rule to each flagged key."""
    info = None
    for no, r in enumerate(rules):
        values = [F.coalesce(F.col(f"k{i}"), F.lit("NA")) for i in range(len(r.batch))]
        value = F.concat_ws("_", *values) if len(values) > 1 else F.col("k0")
        s = F.struct(
            *rule_columns(r.rule),
            F.lit(r.column or ",".join(r.batch)).alias("column"),
            value.alias("value"),
        )
        hit = F.col(RULE_NO) == no
        info = F.when(hit, s) if info is None else info.when(hit, s)
    return (
        flagged.select(info.alias("r"), "entity", "entry_file")
        .select("r.*", "entity", "entry_file", F.lit(None).cast("map<string,string>").alias("detail"))
        .select(*VIOLATION_COLUMNS)
    )


def check_new_values(
    batch: DataFrame, history: DataFrame, column: str, rule: Rule | None = None, entry_file: str = "entry_file"
) -> DataFrame:
    """Distinct (value, file) of the batch whose value history lacks.  A null counts as a value."""
    return check_new_values_multi(batch, history, [column], rule and {column: rule}, entry_file)


def check_new_values_multi(
    batch: DataFrame,
    history: DataFrame,
    columns: Sequence[str],
    rules: Mapping[str, Rule] | None = None,
    entry_file: str = "entry_file",
) -> DataFrame:
    """:func:`check_new_values` for several columns with one scan of each side."""
    rules = rules or {}
    key_rules = [
        KeyRule(rules.get(c, Rule(f"new_{c}", i)), (c,), {"history": (c,)}) for i, c in enumerate(columns)
    ]
    return check_keys(batch, {"history": history}, key_rules, entry_file)


def check_repeats(
    batch: DataFrame,
    history: DataFrame,
    columns: str | Sequence[str],
    rule: Rule | None = None,
    skip_nulls: bool = False,
    entry_file: str = "entry_file",
) -> DataFrame:
    """Distinct (value, file) of the batch whose value history already holds."""
    names = (columns,) if isinstance(columns, str) else tuple(columns)
    rule = rule or Rule("repeat_" + "_".join(names))
    key_rule = KeyRule(rule, names, {"history": names}, unseen=False, skip_nulls=skip_nulls)
    return check_keys(batch, {"history": history}, [key_rule], entry_file)


def check_new_combos(
    batch: DataFrame, history: DataFrame, columns: Sequence[str], rule: Rule | None = None, entry_file: str = "entry_file"
) -> DataFrame:
    """Distinct (combination, file) whose combination history lacks."""
    names = tuple(columns)
    key_rule = KeyRule(rule or Rule("new_" + "_".join(names)), names, {"history": names})
    return check_keys(batch, {"history": history}, [key_rule], entry_file)


def check_precedent(
    batch: DataFrame,
    history: DataFrame,
    group: Sequence[str],
    applied: str,
    recaptured: str,
    rule: Rule | None = None,
    entity: str | None = None,
    entry_file: str = "entry_file",
) -> DataFrame:
    """Recaptured (group, mark) that was never applied, neither in history nor in the batch itself.

    Only the mark must be present; a null in the group is a value like any other.
    """
    rule = rule or Rule("no_precedent_" + recaptured)
    key_rule = KeyRule(
        rule,
        (*group, recaptured),
        {"history": (*group, applied), "batch": (*group, applied)},
        required=recaptured,
        entity=entity,
        column=recaptured,
    )
    return check_keys(batch, {"history": history, "batch": batch}, [key_rule], entry_file)


def check_vocab(
    df: DataFrame,
    column: str,
    allowed: Sequence[str],
    rule: Rule | None = None,
    entry_file: str = "entry_file",
    allow_null: bool = False,
) -> DataFrame:
    """Distinct (value, file) outside a fixed vocabulary."""
    c = F.col(column)
    bad = c.isNull() if not allow_null else F.lit(False)
    return _distinct_values(df, bad | ~c.isin(*allowed), column, rule or Rule("vocab_" + column), entry_file)


def check_retired(
    df: DataFrame, column: str, retired: Sequence, rule: Rule | None = None, entry_file: str = "entry_file"
) -> DataFrame:
    """Distinct (value, file) whose value is on the retired list."""
    hit = F.col(column).isin(*retired)
    return _distinct_values(df, hit, column, rule or Rule("retired_" + column), entry_file)


def _distinct_values(df: DataFrame, condition: Column, column: str, rule: Rule, entry_file: str) -> DataFrame:
    rows = (
        df.filter(condition)
        .select(key_text(df, column).alias("value"), F.col(f"`{entry_file}`").alias("entry_file"))
        .distinct()
    )
    return as_violations(
        rows, rule, column=column, value=F.col("value"), entry_file=F.col("entry_file")
    )


def duplicated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count.  Counts combine map-side."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def doubtful_hashes(batch: DataFrame, history: Sequence[DataFrame], column: str, scratch: str) -> DataFrame:
    """``hash`` of each key that may occur more than once in the batch, or in history too.

    Where almost no key does, this finds the few that are worth comparing as text: only numbers are
    shuffled, and :func:`doubtful_rows` then drops the other rows in the scan.  Two tables are staged: the
    batch's hashes, whose size no estimate from the batch's other columns would tell, and the result.
    """
    counted = batch.select(_key_hash(batch, column)).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    asked = stage(counted, f"{scratch}/hashes")
    known = reduce(DataFrame.unionByName, [h.select(_key_hash(h, column)) for h in history]).distinct()
    seen = known.join(asked.select("hash"), "hash", "left_semi")
    return stage(asked.filter("n > 1").select("hash").unionByName(seen).distinct(), f"{scratch}/doubtful")


def doubtful_rows(df: DataFrame, column: str, hashes: DataFrame) -> DataFrame:
    """Rows whose key has one of the hashes."""
    return df.join(hashes, _key_hash(df, column) == hashes["hash"], "left_semi")


def _key_hash(df: DataFrame, column: str) -> Column:
    return F.xxhash64(key_text(df, column)).alias("hash")


def check_duplicate_keys(
    batch: DataFrame, columns: str | Sequence[str], rule: Rule | None = None, entry_file: str = "entry_file"
) -> DataFrame:
    """Every row of the batch whose key occurs more than once in it.

    Counting first and joining back, rather than a window, keeps a key that holds much of the batch
    out of a single task: the join is one that adaptive execution can split.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    rule = rule or Rule("dup_" + "_".join(names))
    dup = duplicated_keys(batch, names).select(*[F.col(c).alias(f"dup_{c}") for c in names])
    rows = batch.join(dup, splittable_on([batch[c] for c in names], [dup[f"dup_{c}"] for c in names]), "left_semi")
    value = F.concat_ws("_", *[F.coalesce(key_text(batch, c), F.lit("NA")) for c in names])
    return as_violations(
        rows, rule, entity=value, column=",".join(names), value=value, entry_file=F.col(f"`{entry_file}`")
    )
