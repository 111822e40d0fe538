"""Analysis views: a projection plan over a wide master, checked and built in one select.

A plan names for each target column its sources and method.  Every source must exist and be
used once; all conflicts are counted by one aggregate before the view is built, so a wide
view takes two passes whatever the number of columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import names
from panelwright.operators.harmonise import ConflictError, YearRule

#: Columns checked by one aggregate, below the limit of code generation.
CHECKS_AT_ONCE = 80


@dataclass(frozen=True)
class Spec:
    target: str
    sources: tuple[str, ...]
    method: str = "copy"  # copy, coalesce or year_partition
    rules: tuple[YearRule, ...] = ()
    exempt: tuple[str, ...] = field(default=())


def make_specs(columns: list[str], groups: list[dict], dropped: tuple[str, ...] = (), suffix_dropped: tuple[str, ...] = ()) -> list[Spec]:
    """The plan: groups of columns are consolidated, columns dropped, the others copied."""
    chosen = [c for c in columns if c not in dropped and not c.endswith(tuple(suffix_dropped) or ("\0",))]
    used: dict[str, Spec] = {}
    for g in groups:
        rules = tuple(YearRule(r["source"], r["min"], r["max"]) for r in g.get("year_rules", []))
        spec = Spec(g["target"], tuple(g["sources"]), g["method"], rules)
        if spec.method not in ("coalesce", "year_partition"):
            raise ConflictError(f"{spec.target}: unknown method {spec.method}")
        for s in spec.sources:
            if s not in chosen:
                raise ConflictError(f"{spec.target}: source {s} is not selected")
            if s in used:
                raise ConflictError(f"source {s} is used twice")
            used[s] = spec
    out: list[Spec] = []
    for c in chosen:
        spec = used.get(c) or Spec(c, (c,))
        if spec not in out:
            out.append(spec)
    clash = names.case_clashes([s.target for s in out])
    if clash:
        raise ConflictError(f"targets differ in case only: {clash}")
    return out


def _known(types: dict[str, str], c: str) -> Column:
    return F.when(~F.isnan(c), F.col(c)) if types[c] in ("double", "float") else F.col(c)


def _value(types: dict[str, str], s: Spec, year: str) -> Column:
    if s.method == "coalesce":
        return F.coalesce(*[_known(types, c) for c in s.sources])
    if s.method == "year_partition":
        out = F.lit(None).cast(types[s.sources[0]])
        for r in s.rules:
            out = F.when(F.col(year).between(r.first, r.last), _known(types, r.source)).otherwise(out)
        return out
    return F.col(s.sources[0])


def _faults(types: dict[str, str], s: Spec, year: str) -> Column:
    if s.method == "coalesce":
        return F.size(F.array_distinct(F.array_compact(F.array(*[_known(types, c) for c in s.sources])))) > 1
    inside = F.lit(False)
    stray = F.lit(False)
    for c in s.sources:
        own = F.lit(False)
        for r in s.rules:
            if r.source == c:
                own = own | F.coalesce(F.col(year).between(r.first, r.last), F.lit(False))
        inside = inside | own
        stray = stray | (~own & _known(types, c).isNotNull() & F.lit(c not in s.exempt))
    return stray | (F.col(year).isNotNull() & ~inside)


def build(df: DataFrame, specs: list[Spec], year: str) -> DataFrame:
    """The view of a plan; raises if sources conflict or values lie outside their years."""
    types = dict(df.dtypes)
    for s in specs:
        ordered = sorted(s.rules, key=lambda r: r.first)
        if any(b.first <= a.last for a, b in zip(ordered, ordered[1:])):
            raise ConflictError(f"{s.target}: years overlap")
    risky = [s for s in specs if s.method != "copy"]
    for i in range(0, len(risky), CHECKS_AT_ONCE):
        some = risky[i : i + CHECKS_AT_ONCE]
        row = df.agg(*[F.count_if(_faults(types, s, year)).alias(s.target) for s in some]).collect()[0].asDict()
        bad = {k: v for k, v in row.items() if v}
        if bad:
            raise ConflictError(f"rows in conflict: {bad}")
    return df.select(*[_value(types, s, year).alias(s.target) for s in specs])


def merged_labels(tables: list[dict[int, str]], strict: bool = True) -> dict[int, str] | None:
    """One label table of several; conflicting labels of a code raise, or drop the labels."""
    out: dict[int, str] = {}
    for t in tables:
        for code, label in t.items():
            if out.setdefault(code, label) != label:
                if strict:
                    raise ConflictError(f"code {code} is labelled {out[code]!r} and {label!r}")
                return None
    return out


def stable_labels(labels: DataFrame, scopes: DataFrame) -> DataFrame:
    """Labels of a variable that never conflict and are there in every scope it occurs in.

    ``labels`` has variable, scope, code, label; ``scopes`` has variable, scope.  Others stay
    year-scoped and get no stable table.
    """
    per = labels.groupBy("variable", "code").agg(F.countDistinct("label").alias("n"), F.min("label").alias("label"))
    whole = per.groupBy("variable").agg(F.max("n").alias("most"))
    need = scopes.select("variable", "scope").distinct()
    have = labels.select("variable", "scope").distinct().withColumn("__h", F.lit(1))
    covered = need.join(have, ["variable", "scope"], "left").groupBy("variable").agg(F.every(F.col("__h").isNotNull()).alias("covered"))
    good = whole.join(covered, "variable").where("most = 1 AND covered").select("variable")
    return per.join(good, "variable", "left_semi").select("variable", "code", "label")
