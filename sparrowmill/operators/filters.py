"""Projections, filters and predicates."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(c: Column, table: dict) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(table.items())))[c]


def map_role(df: DataFrame, category: str, roles: dict) -> DataFrame:
    """Categories without a role are dropped."""
    return df.withColumn("role", lookup(F.col(category), roles)).where("role is not null")


def code_to_words(c: Column, places: list[dict]) -> Column:
    """A fixed-position code to words; NULL when any place is unknown or the length differs."""
    words = [lookup(F.substring(c, i + 1, 1), p) for i, p in enumerate(places)]
    known = reduce(lambda a, b: a & b, [w.isNotNull() for w in words]) & (F.length(c) == len(places))
    return F.when(known, F.concat_ws(" ", *words))


def first_match(c: Column, exact: dict, ordered: list[tuple[str, str]], default: str) -> Column:
    rules = reduce(lambda w, r: w.when(c.contains(r[0]), r[1]), ordered, F.when(F.lit(False), default)).otherwise(default)
    return F.coalesce(lookup(c, exact), rules)


def min_duration(df: DataFrame, cls: str, seconds: str, least: dict, on_fail: str = "drop") -> DataFrame:
    """Classes without a limit pass; on_fail is drop or raise."""
    short = F.coalesce(F.col(seconds) < lookup(F.col(cls), least), F.lit(False))
    if on_fail == "raise":
        return df.where(F.when(short, F.raise_error(F.concat(F.lit("too short: "), F.col(cls))).cast("boolean")).otherwise(True))
    return df.where(~short)


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds the names of the rules a row breaks; unknown counts as kept."""
    return df.withColumn("violations", F.array_compact(F.array(*[F.when(r, name) for name, r in rules.items()])))


def split_mask(split: Column, want: str) -> Column:
    return {"all": F.lit(True), "heldout": split.isin("val", "test")}.get(want, split == want)


def holdout_filter(df: DataFrame, split: Column, want: str, mode: str, group: str, held: str) -> DataFrame:
    """exclude drops the held-out group, include ignores it, only keeps it alone and in any split."""
    is_held = F.col(group).eqNullSafe(held)
    keep = {"exclude": split_mask(split, want) & ~is_held, "only": is_held, "include": split_mask(split, want)}[mode]
    return df.where(keep)


def apply_allowlist(df: DataFrame, allow: DataFrame, key: str, flag: Column) -> DataFrame:
    """Adds `flagged`: the flag unless the key is allowed."""
    return df.join(allow.select(key).distinct().withColumn("_ok", F.lit(True)), key, "left").withColumn("flagged", F.coalesce(flag, F.lit(False)) & F.col("_ok").isNull()).drop("_ok")


def relative_path(c: Column, root: str) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), root, "")


def schedule(index: Column, stages: list[tuple[int, str]]) -> Column:
    """First stage whose end exceeds the index; the last one beyond all."""
    return reduce(lambda w, s: w.when(index < s[0], s[1]), stages, F.when(F.lit(False), "")).otherwise(stages[-1][1])


def weighted_draw(u: Column, weights: dict[str, float]) -> Column:
    total, acc, out = sum(weights.values()), 0.0, F.when(F.lit(False), "")
    for name, w in weights.items():
        acc += w
        out = out.when(u < acc / total, name)
    return out.otherwise(next(reversed(weights)))


def coupled(ref: Column, u: Column, base: float, span: float, noise: float) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), base + ref / span + noise * (2 * u - 1)))


def ratio_eligible(found: Column, expected: Column, lo: float = 0.8, hi: float = 1.25) -> Column:
    return F.coalesce((found / F.nullif(expected, F.lit(0))).between(lo, hi), F.lit(False))


def parse_key(c: Column, grammar: str, names: list[str], strict: bool = False) -> Column:
    """Groups of a filename grammar as a struct of strings, null where the name does not match; strict raises."""
    parts = F.struct(*[F.nullif(F.regexp_extract(c, grammar, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)])
    bad = F.raise_error(F.concat(F.lit("not in the grammar: "), c)) if strict else F.lit(None)
    return F.when(c.rlike(grammar), parts).otherwise(bad.cast("struct<" + ",".join(f"{n}:string" for n in names) + ">"))


def labels_to_pools(df: DataFrame, labels: str, plain: dict[str, list[str]], voiced: dict[str, list[str]], voice: list[str], never: list[str]) -> DataFrame:
    """A row per pool whose labels the row has (array `labels`). Rows with a voice label follow
    the second rule table; a label of `never` keeps a row out of every pool."""
    has = lambda ws: F.arrays_overlap(F.col(labels), F.array(*map(F.lit, ws)))
    pools = lambda rules: F.array_compact(F.array(*[F.when(has(ws), p) for p, ws in rules.items()])) if rules else F.array().cast("array<string>")
    own = F.when(F.coalesce(has(never), F.lit(False)), F.array().cast("array<string>")).when(has(voice), pools(voiced)).otherwise(pools(plain))
    return df.withColumn("pool", F.explode(own))


def route_clipped(df: DataFrame, clip_frac: Column, most: float = 0.001) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows with too large a share of clipped samples; unknown shares pass."""
    bad = F.coalesce(clip_frac > most, F.lit(False))
    return df.where(~bad), df.where(bad)


def contract_violations(df: DataFrame, a: str, b: str, silent: float = 1e-4) -> DataFrame:
    """Adds the rules a pair of channels breaks: present, equal length, finite, target not silent, within one."""
    x, y = F.col(a), F.col(b)
    finite = lambda c: F.forall(c, lambda v: ~F.isnan(v) & (F.abs(v) < float("inf")))
    most = lambda c: F.array_max(F.transform(c, lambda v: F.abs(v.cast("double"))))
    return violations(df, {"missing": x.isNull() | y.isNull(), "length": F.size(x) != F.size(y), "finite": ~(finite(x) & finite(y)),
                           "silent": F.coalesce(most(y), F.lit(0.0)) < silent, "range": (most(x) > 1) | (most(y) > 1)})


def quarantine(df: DataFrame, bad: Column, pile: str, refuse: list[str], dry_run: bool = True):
    """Rows to be set aside, counted by pile in a dry run; otherwise (kept, set aside). Piles in `refuse` raise if a row of theirs is bad."""
    hit = F.when(F.coalesce(bad, F.lit(False)) & F.col(pile).isin(refuse), F.raise_error(F.concat(F.lit("refused pile "), F.col(pile))).cast("boolean")).otherwise(F.coalesce(bad, F.lit(False)))
    if dry_run:
        return df.where(hit).groupBy(pile).agg(F.count(F.lit(1)).alias("n"))
    return df.where(~hit), df.where(hit)


def needs_screen(cls: Column, pile: Column, classes: list[str], exempt: list[str]) -> Column:
    """Only noise classes are screened, and no curated pile."""
    return F.coalesce(cls.isin(classes), F.lit(False)) & ~F.coalesce(pile.isin(exempt), F.lit(False))


def derive_label(cls: Column, far: Column, automatic: Column) -> Column:
    """Distant and automatic forms of a class come before its plain name; far wins."""
    return F.when(F.coalesce(far, F.lit(False)), F.concat(cls, F.lit("_distant"))).when(F.coalesce(automatic, F.lit(False)), F.concat(cls, F.lit("_auto"))).otherwise(cls)


def import_by_class(df: DataFrame, folder: str, classes: dict[str, str], never: list[str]) -> DataFrame:
    """Adds `cls`; folders without a class and those never to be imported are left out."""
    return df.withColumn("cls", lookup(F.col(folder), classes)).where(F.col("cls").isNotNull() & ~F.col(folder).isin(never))


def attach_dim(df: DataFrame, dim: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """Adds a dimension's value, or the default where the dimension lacks the key. Catalyst picks the join by the sizes it measures."""
    return df.join(dim.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def audited_only(df: DataFrame, audit: DataFrame, key: str, ok: Column) -> DataFrame:
    """Rows that pass the audit or were never audited."""
    return df.join(audit.select(key, ok.alias("_ok")), key, "left").where(F.coalesce("_ok", F.lit(True))).drop("_ok")


def join_all(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One-to-one join: a key of `a` that `b` lacks raises when the row is computed."""
    both = a.join(b.withColumn("_hit", F.lit(True)), key, "left")
    missing = F.raise_error(F.concat(F.lit("no row for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")
    return both.where(F.when(F.col("_hit").isNull(), missing).otherwise(True)).drop("_hit")
