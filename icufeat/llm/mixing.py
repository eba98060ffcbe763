"""Mixing sources to target weights by iterative proportional fitting.

Token counts of the cells (source, language, topic) are raked until their sums follow the
target shares of all three. The weights then become probabilities that draw a sample of
the wanted size, and each document is drawn by a hash of its own.

Languages and topics are few, sources may be many. So the cells are kept as one row per
source, each round adds them up to one number per language and topic, and the driver
holds only these factors; a source's own factor follows from them within its row.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icufeat.llm.common import WORD, join_facts, stored

#: A group's target share goes with its tokens to this power: 1 leaves the shares, 0 makes them equal.
POWER = 0.7
#: Share of the tokens that the sample has.
BUDGET = 0.5
ROUNDS, CLOSE = 200, 1e-12
#: Rounds in a row that change the sums as much as the round before: the targets are out of reach.
STALLED = 5
#: Targets count as met up to this share; weights below LEAST_WEIGHT of the largest do not stretch the search for the scale.
MET, LEAST_WEIGHT = 1e-6, 1e-15
SEED = "mix"
#: Topics by the first pattern that the text holds.
TOPICS = (("legal", "(?i)licen[cs]e|copyright"), ("contact", r"@|\+1 \("), ("table", r"\|"), ("numeric", "[0-9]{4}"))
OTHER_TOPIC = "prose"
NO_LANGUAGE, NO_SOURCE = "und", ""


@dataclass(frozen=True)
class Targets:
    """Wanted shares of the tokens by source, language and topic; a group that is not named gets none.

    They need not add up to 1. An empty mapping takes the table's own shares to the power
    `power`. Names without tokens in the table are left out, and the others fill their place.
    """

    sources: Mapping[str, float] = field(default_factory=dict)
    languages: Mapping[str, float] = field(default_factory=dict)
    topics: Mapping[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for shares in (self.sources, self.languages, self.topics):
            if shares and not (all(0 <= v < float("inf") for v in shares.values()) and any(shares.values())):
                raise ValueError("target shares are at least 0, and one of them above")


@dataclass(frozen=True)
class Mix:
    """Factors per source (a stored frame), and per language and topic; `scale` turns weights into probabilities.

    `error` is how far, at most, a group's tokens are from its target, as a share of the
    target (`missed` by group): targets that no weights can meet leave it above CLOSE.
    """

    sources: DataFrame
    factors: dict[tuple[str, str], float]
    scale: float
    rows: int
    rounds: int
    error: float
    missed: dict[str, float] = field(default_factory=dict)


def topic_of(text: Column, topics: tuple[tuple[str, str], ...] = TOPICS) -> Column:
    out = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(topics):
        out = F.when(F.rlike(text, F.lit(pattern)), F.lit(name)).otherwise(out)
    return out


def with_cells(docs: DataFrame, *, key: str = "doc_id", text: str = "text", topic: Column | None = None) -> DataFrame:
    """`docs` with __source, __lang, __topic, __tokens (words) and __draw (in [0, 1), from id and text); nulls are groups of their own.

    `topic` is any expression over the columns of `docs`; without it the patterns TOPICS decide.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat_ws("|", F.lit(SEED), F.col(key).cast("string"), body))
    return docs.select(
        "*",
        F.coalesce("source", F.lit(NO_SOURCE)).alias("__source"),
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("__lang"),
        (topic_of(body) if topic is None else F.coalesce(topic.cast("string"), F.lit(OTHER_TOPIC))).alias("__topic"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("__tokens"),
        (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))).alias("__draw"),
    )


def _factor(lang: Column, topic: Column, factors: Mapping[tuple[str, str], float]) -> Column:
    if not factors:
        return F.lit(0.0)
    table = F.create_map(*[F.lit(x) for (a, b), v in factors.items() for x in (f"{a}\u0000{b}", float(v))])
    return F.coalesce(F.try_element_at(table, F.concat(lang, F.lit("\u0000"), topic)), F.lit(0.0))


def _wished(cells: DataFrame, wished: Targets) -> DataFrame:
    """`cells` where groups whose target is 0 have no tokens."""
    keep = F.lit(True)
    for column, shares in (("__source", wished.sources), ("__lang", wished.languages), ("__topic", wished.topics)):
        if shares:
            keep = keep & F.col(column).isin([k for k, v in shares.items() if v > 0])
    return cells.withColumn("__tokens", F.when(keep, F.col("__tokens")).otherwise(F.lit(0).cast("long")))


def fit_mix(cells: DataFrame, *, power: float = POWER, budget: float = BUDGET, targets: Targets | None = None) -> Mix:
    """Factors that rake the tokens of `cells` (columns of `with_cells`) to target shares of source, language and topic.

    Documents without a word weigh nothing, nor do those of groups whose target is 0. A
    table without words that count gives a mix without factors.
    """
    wished = targets or Targets()
    cells = _wished(cells, wished)
    sums = cells.groupBy("__source", "__lang", "__topic").agg(F.sum("__tokens").alias("tokens"), F.count("*").alias("n"))
    per_source = stored(
        sums.groupBy("__source").agg(
            F.array_sort(F.collect_list(F.when(F.col("tokens") > 0, F.struct("__lang", "__topic", "tokens")))).alias("cells"),
            F.sum("tokens").alias("total"),
            F.sum("n").alias("n"),
        ),
        "mix-cells",
    )
    share = F.pow("total", F.lit(power))
    if wished.sources:
        table = F.create_map(*[F.lit(x) for k, v in wished.sources.items() for x in (k, float(v))])
        share = F.coalesce(F.try_element_at(table, F.col("__source")), F.lit(0.0))
    share = F.when(F.col("total") > 0, share).otherwise(0.0)
    whole = per_source.agg(F.sum("total").alias("tokens"), F.sum("n").alias("n"), F.sum(share).alias("shares")).first()
    if not whole.tokens:
        return Mix(per_source.select("__source", "n", F.lit(0.0).alias("factor")), {}, 0.0, whole.n or 0, 0, 0.0, {})
    flat = per_source.select("total", F.inline("cells"))
    base = {(r[0], r[1]): float(r[2]) for r in flat.groupBy("__lang", "__topic").agg(F.sum("tokens")).collect()}
    total = float(whole.tokens)

    def goals(at: int, shares: Mapping[str, float]) -> dict[str, float]:
        own: dict[str, float] = {}
        for k, v in base.items():
            own[k[at]] = own.get(k[at], 0.0) + v
        own = {k: float(shares[k]) if shares else v**power for k, v in own.items()}
        return {k: total * v / sum(own.values()) for k, v in own.items()}

    by_lang, by_topic = goals(0, wished.languages), goals(1, wished.topics)
    b, c = dict.fromkeys(by_lang, 1.0), dict.fromkeys(by_topic, 1.0)
    wanted = share / F.lit(float(whole.shares)) * F.lit(total)

    def raked(factors: Mapping[tuple[str, str], float]) -> DataFrame:
        weighed = F.aggregate("cells", F.lit(0.0), lambda s, x: s + x["tokens"] * _factor(x["__lang"], x["__topic"], factors))
        return per_source.withColumn("factor", F.when(F.col("total") > 0, F.coalesce(F.try_divide(wanted, weighed), F.lit(0.0))).otherwise(0.0))

    def all_factors() -> dict[tuple[str, str], float]:
        return {k: b[k[0]] * c[k[1]] for k in base}

    def sums_with(raked_sources: DataFrame) -> dict[tuple[str, str], float]:
        sums_now = raked_sources.select("factor", F.inline("cells")).groupBy("__lang", "__topic").agg(F.sum(F.col("factor") * F.col("tokens")))
        return {(r[0], r[1]): r[2] for r in sums_now.collect()}

    rounds, moved, stalled = 0, 1.0, 0
    while rounds < ROUNDS and moved > CLOSE and stalled < STALLED:
        rounds += 1
        m = sums_with(raked(all_factors()))
        before, moved = moved, 0.0
        for own, at, goal in ((b, 0, by_lang), (c, 1, by_topic)):
            got = dict.fromkeys(goal, 0.0)
            for k, v in m.items():
                got[k[at]] += v * b[k[0]] * c[k[1]]
            for name in own:
                # Targets out of reach drive a group's weights to nothing.
                change = goal[name] / got[name] if got[name] > 0 else 1.0
                moved = max(moved, abs(change - 1))
                own[name] *= change
        stalled = stalled + 1 if abs(before - moved) <= MET * moved else 0

    factors = all_factors()
    sources = stored(raked(factors).select("__source", "n", "cells", "factor"), "mix-sources")
    weights = sources.select("factor", F.inline("cells")).select("tokens", (F.col("factor") * _factor(F.col("__lang"), F.col("__topic"), factors)).alias("w"))
    missed: dict[str, float] = {}
    final = sums_with(sources)
    for kind, at, goal in (("language", 0, by_lang), ("topic", 1, by_topic)):
        for name, want in goal.items():
            got = sum(v * factors[k] for k, v in final.items() if k[at] == name)
            missed[f"{kind} {name}"] = got / want - 1
    error = max(map(abs, missed.values()))
    ends = weights.agg(F.min(F.when(F.col("w") > 0, F.col("w"))), F.max("w")).first()

    def sizes(scales: list[float]) -> list[float]:
        return list(weights.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("w") * s)) for s in scales]).first())

    # The expected size rises with the scale, along straight lines between the places where a cell reaches 1.
    lo, hi = 0.5 / ends[1], 1.0 / max(ends[0], ends[1] * LEAST_WEIGHT)
    for _ in range(4):
        grid = [lo * (hi / lo) ** (i / 48) for i in range(49)]
        got = sizes(grid)
        at = next((i for i, v in enumerate(got) if v >= budget * total), 48)
        if at == 0:  # below this scale no cell reaches 1
            lo, hi, got_lo, got_hi = 0.0, grid[0], 0.0, got[0]
            break
        lo, hi, got_lo, got_hi = grid[at - 1], grid[at], got[at - 1], got[at]
    scale = lo + (hi - lo) * min(1.0, (budget * total - got_lo) / (got_hi - got_lo)) if got_hi > got_lo else hi
    return Mix(sources.drop("cells"), factors, float(scale), whole.n, rounds, error, missed)


def with_probability(cells: DataFrame, mix: Mix) -> DataFrame:
    """The columns of `cells` with __weight (wanted tokens for each there is) and __p, the probability to be drawn: 0 for a text without words."""
    joined = join_facts(cells, mix.sources.withColumnRenamed("factor", "__factor"), "__source", "n", mix.rows, F.col("__draw"))
    weight = F.coalesce("__factor", F.lit(0.0)) * _factor(F.col("__lang"), F.col("__topic"), mix.factors)
    p = F.when(F.col("__tokens") > 0, F.least(F.lit(1.0), F.col("__weight") * F.lit(mix.scale))).otherwise(0.0)
    return joined.withColumn("__weight", weight).withColumn("__p", p).drop("__factor")


def _fitted(cells: DataFrame, power: float, budget: float, targets: Targets | None) -> Mix:
    """The fitted mix, with a warning where it misses its targets."""
    mix = fit_mix(cells, power=power, budget=budget, targets=targets)
    if mix.error > MET:
        worst = max(mix.missed, key=lambda k: abs(mix.missed[k]))
        warnings.warn(f"the target of {worst} is missed by {mix.missed[worst]:+.3g} of it", stacklevel=3)
    return mix


def draw(
    docs: DataFrame, *, power: float = POWER, budget: float = BUDGET, key: str = "doc_id", text: str = "text", targets: Targets | None = None, topic: Column | None = None
) -> DataFrame:
    """The rows of `docs`, all columns, that the sample holds.

    `budget` is a share of the tokens of the groups that have a target. Targets that cannot all be met give a warning.
    """
    cells = with_cells(docs, key=key, text=text, topic=topic)
    chosen = with_probability(cells, _fitted(cells, power, budget, targets)).filter(F.col("__draw") < F.col("__p"))
    return chosen.select(*docs.columns)


def mix_table(
    docs: DataFrame, *, power: float = POWER, budget: float = BUDGET, key: str = "doc_id", text: str = "text", targets: Targets | None = None, topic: Column | None = None
) -> DataFrame:
    """(key, source, lang, topic, tokens, weight, probability, selected) of every row.

    A null source is the source ``, a null language `und`; a null text has no words, and a
    text without words, or of a group whose target is 0, is never selected. Repeated rows share a draw. A cell whose
    probability would exceed 1 is taken whole.
    """
    # The texts are read once: what the draw needs of them is stored.
    cells = stored(with_cells(docs, key=key, text=text, topic=topic).select(key, "__source", "__lang", "__topic", "__tokens", "__draw"), "mix-rows")
    out = with_probability(cells, _fitted(cells, power, budget, targets))
    return out.select(
        key,
        F.col("__source").alias("source"),
        F.col("__lang").alias("lang"),
        F.col("__topic").alias("topic"),
        F.col("__tokens").alias("tokens"),
        F.col("__weight").alias("weight"),
        F.col("__p").alias("probability"),
        (F.col("__draw") < F.col("__p")).alias("selected"),
    )


def mix_sql(power: float = POWER, budget: float = BUDGET, rounds: int = 40) -> str:
    """The same in SQL, with the rounds written out; probabilities to six digits, weights to six significant ones."""
    topics = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS)
    steps = []
    for i in range(rounds):
        steps.append(f"""
  a{i} AS MATERIALIZED (SELECT source, any_value(goals.goal) / sum(tokens * b * c) AS a FROM goals JOIN cells USING (source) JOIN l{i} USING (lang) JOIN t{i} USING (topic) GROUP BY source),
  l{i + 1} AS MATERIALIZED (SELECT lang, any_value(l.b) * any_value(l.goal) / sum(tokens * a * b * c) AS b, any_value(l.goal) AS goal FROM l{i} l JOIN cells USING (lang) JOIN a{i} USING (source) JOIN t{i} USING (topic) GROUP BY lang),
  t{i + 1} AS MATERIALIZED (SELECT topic, any_value(t.c) * any_value(t.goal) / sum(tokens * a * b * c) AS c, any_value(t.goal) AS goal FROM t{i} t JOIN cells USING (topic) JOIN a{i} USING (source) JOIN l{i + 1} USING (lang) GROUP BY topic)""")
    n = rounds
    goal = lambda by: f"(SELECT {by}, pow(sum(tokens), {power}) AS g FROM cells GROUP BY {by})"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, 'und') AS lang, coalesce(text, '') AS t FROM documents
), r AS MATERIALIZED (
  SELECT doc_id, source, lang, CASE {topics} ELSE '{OTHER_TOPIC}' END AS topic,
         CAST(len(regexp_extract_all(t, '{WORD}')) AS BIGINT) AS tokens,
         CAST('0x' || substr(md5(concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR), t)), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM d
), cells AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM r GROUP BY ALL HAVING sum(tokens) > 0
), whole AS MATERIALIZED (SELECT sum(tokens) AS n FROM cells),
  goals AS MATERIALIZED (SELECT source, g / sum(g) OVER () * (SELECT n FROM whole) AS goal FROM {goal("source")}),
  l0 AS MATERIALIZED (SELECT lang, 1.0::DOUBLE AS b, g / sum(g) OVER () * (SELECT n FROM whole) AS goal FROM {goal("lang")}),
  t0 AS MATERIALIZED (SELECT topic, 1.0::DOUBLE AS c, g / sum(g) OVER () * (SELECT n FROM whole) AS goal FROM {goal("topic")}),{",".join(steps)},
  af AS MATERIALIZED (SELECT source, any_value(goals.goal) / sum(tokens * b * c) AS a FROM goals JOIN cells USING (source) JOIN l{n} USING (lang) JOIN t{n} USING (topic) GROUP BY source),
  w AS MATERIALIZED (SELECT source, lang, topic, tokens, a * b * c AS w FROM cells JOIN af USING (source) JOIN l{n} USING (lang) JOIN t{n} USING (topic)),
  o AS (
    SELECT w, coalesce(sum(tokens) OVER (ORDER BY w DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
           sum(tokens * w) OVER (ORDER BY w DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM w
  ), s AS (SELECT arg_max(({budget} * (SELECT n FROM whole) - capped) / rest, w) FILTER (({budget} * (SELECT n FROM whole) - capped) / rest * w <= 1) AS scale FROM o)
SELECT doc_id, r.source, r.lang, r.topic, r.tokens, round(w.w, 6) AS weight,
       round(CASE WHEN r.tokens > 0 THEN least(1.0, w.w * (SELECT scale FROM s)) ELSE 0.0 END, 6) AS probability,
       u < CASE WHEN r.tokens > 0 THEN least(1.0, w.w * (SELECT scale FROM s)) ELSE 0.0 END AS selected
FROM r LEFT JOIN w ON r.source = w.source AND r.lang = w.lang AND r.topic = w.topic
"""
