"""URL filtering: host and path rules first, then trust and distrust on the host graph.

Everything is a DataFrame or SQL expression. Host edges come from absolute
links in the pages and, by default, from every host to its parent domain.
Trust is personalised PageRank from hosts with allowed pages; distrust is the
same walk over reversed edges from hosts with blocked pages, so a host that
links to blocked hosts is distrusted. Both run in one loop over a common
edge table, whose direction is part of its key, until the scores converge.

Scores are doubles, shares of the seed pages of a kind, so that neither many
seed pages nor many links of a host round a score down to 0. A host whose
distrust is larger than its trust by more than a millionth is blocked. That
margin lies far above what the order of rows changes in a sum, so equal scores
allow a host in every run.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise

# fixed values: kind, host, path prefix
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ROUNDS = 8              # of the oracle's SQL only
UNIT = 1_000_000_000    # of the oracle's SQL only
DAMPING = 85            # hundredths of a score that go along edges
STEPS = 4               # rounds between two looks at the change
TOLERANCE = 1e-9        # share of its score by which a host may still have changed in the last STEPS rounds
MARGIN = 1e-6           # share of its trust by which a blocked host's distrust is larger at least
LIMIT = 2000            # rounds after which the walk gives up with an error


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://`` (null without one)."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and kind of the longest rule that fits (ties: the first listed), null where none does."""
    text, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        kind = F.when(fits, F.lit(what)).otherwise(kind)
    return text, kind


def linked_hosts(html: Column) -> Column:
    """Hosts of absolute (or scheme-relative) links in a page."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""href\s*=\s*["']?(?:[hH][tT][tT][pP][sS]?:)?//([^/?#"'\s>]+)"""), 1)
    return F.transform(links, lower_ascii)


def host_edges(pages: DataFrame, parents: bool = True) -> DataFrame:
    """``(src, dst, w)``: links between different hosts and their number; ``parents`` adds one from every host of
    more than two labels, and from its parents, to the domain one label up. ``pages`` has host and html."""
    edges = pages.select(F.col("host").alias("src"), F.explode(linked_hosts(F.col("html"))).alias("dst"))
    if parents:
        labels = F.split("host", r"\.")
        ups = F.when(F.size(labels) > 2, F.sequence(F.lit(1), F.size(labels) - 2))       # null: no parent
        name = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")           # noqa: E731
        chain = F.explode(F.transform(ups, lambda i: F.struct(name(i).alias("src"), name(i + 1).alias("dst"))))
        edges = edges.unionAll(pages.select("host").distinct().select(chain.alias("e")).select("e.src", "e.dst").distinct())
    return (edges.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w")))


def seed_shares(pages_of: DataFrame) -> DataFrame:
    """``(kind, host, base)``: each seed host's share of the pages (``n``) of its kind."""
    total = pages_of.groupBy("kind").agg(F.sum("n").alias("all"))
    return pages_of.join(F.broadcast(total), "kind").select("kind", "host", F.expr("n / all").alias("base"))


def propagate(edges: DataFrame, seeds: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``(kind, host, score)`` of the converged walk. ``edges``: kind, src, dst, w; ``seeds``: kind, host, base.

    The walk starts from the seeds' own part, so scores only grow. It ends when no score has grown by more than
    ``TOLERANCE`` of itself in ``STEPS`` rounds; a host reached in them has grown by all of its score, so every host
    that the edges reach has one, however far. After ``limit`` rounds it raises an error.

    Each step shuffles rank rows and edge sums by host; the edge table is
    read back from the shared folder, already with its out-weight."""
    out = edges.groupBy("kind", "src").agg(F.sum("w").alias("total"))
    weighted = materialise(edges.join(out, ["kind", "src"]), "host-edges")
    seeds = materialise(seeds, "host-seeds")
    stay = seeds.select("kind", "host", F.expr(f"cast(base as double) * {100 - DAMPING} / 100").alias("s"))
    ranks = before = stay.withColumnRenamed("s", "score")
    for i in range(1, limit + 1):
        moved = (weighted.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"])
                 .select("kind", F.col("dst").alias("host"), F.expr(f"score * {DAMPING}d * w / (100d * total)").alias("s")))
        ranks = moved.unionAll(stay).groupBy("kind", "host").agg(F.sum("s").alias("score"))
        if i % STEPS == 0:
            ranks = materialise(ranks, "host-ranks")
            if not _grown(before, ranks):
                return ranks
            before = ranks
    raise RuntimeError(f"host scores still change after {limit} rounds")


def _grown(before: DataFrame, after: DataFrame) -> int:
    """How many hosts' scores have grown by more than ``TOLERANCE`` of what they are after."""
    zero = F.lit(0.0)
    both = after.select("kind", "host", F.col("score").alias("new"), zero.alias("old")).unionAll(
        before.select("kind", "host", zero.alias("new"), F.col("score").alias("old")))
    sums = both.groupBy("kind", "host").agg(F.sum("new").alias("new"), F.sum("old").alias("old"))
    return sums.filter(F.col("new") - F.col("old") > TOLERANCE * F.col("new")).count()


def judge(pages: DataFrame, rules=RULES, limit: int = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict (``allow`` or ``block``) of every row of ``pages``.

    A url that is null or has no ``://`` has empty host and path, fits no
    rule and is allowed, as are hosts that neither walk reaches. Repeated rows
    count as often as they occur. Null html has no links."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    text, kind = rule_of(F.col("host"), F.col("path"), rules)
    ruled = rows.select("page_id", "host", "path", text.alias("rule"), kind.alias("kind"))
    pages_of = ruled.filter(F.col("kind").isNotNull() & (F.col("host") != "")).groupBy("kind", "host").agg(F.count(F.lit(1)).alias("n"))
    seeds = seed_shares(pages_of)
    edges = host_edges(rows)
    both = edges.select(F.lit("allow").alias("kind"), "src", "dst", "w").unionAll(
        edges.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    scores = (propagate(both, seeds, limit).groupBy(F.col("host").alias("h"))
              .agg(*[F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(name) for k, name in (("allow", "trust"), ("block", "distrust"))]))
    verdict = F.coalesce(F.col("kind"), F.when(F.col("distrust") > F.col("trust") * (1 + MARGIN), F.lit("block")).otherwise(F.lit("allow")))
    return (ruled.join(scores, F.col("host") == F.col("h"), "left")
            .select("page_id", "host", "path", "rule", verdict.alias("verdict")))


def _host_sql() -> str:
    walk = []
    for i in range(ROUNDS):
        walk.append(f"""
r{i + 1} AS (
  SELECT kind, host, CAST(sum(s) AS BIGINT) AS score FROM (
    SELECT kind, dst AS host, CAST(sum(s) AS HUGEINT) * {DAMPING} // 100 AS s FROM (
      SELECT e.kind, e.dst, CAST(r.score AS HUGEINT) * e.w // e.total AS s
      FROM weighted e JOIN r{i} r ON r.kind = e.kind AND r.host = e.src) GROUP BY 1, 2
    UNION ALL SELECT kind, host, base * {100 - DAMPING} // 100 FROM seeds)
  GROUP BY 1, 2)""")
    return ",".join(walk)


def _rule_sql(what: int) -> str:
    whens = "".join(
        f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{k if what else h + p}'"
        for k, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    return f"CASE{whens} END"


ORACLE = rf"""
WITH u AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, html,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
ruled AS (SELECT page_id, html, host, path, {_rule_sql(0)} AS rule, {_rule_sql(1)} AS kind FROM h),
seeds AS (
  SELECT kind, host, CAST(n * {UNIT} // sum(n) OVER (PARTITION BY kind) AS BIGINT) AS base
  FROM (SELECT kind, host, count(*) AS n FROM ruled WHERE kind IS NOT NULL AND host <> '' GROUP BY 1, 2)),
links AS (
  SELECT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''),
    'href\s*=\s*["'']?(?:[hH][tT][tT][pP][sS]?:)?//([^/?#"''\s>]+)', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM ruled),
labels AS (SELECT string_split(host, '.') AS l FROM (SELECT DISTINCT host FROM ruled)),
chain AS (
  SELECT DISTINCT array_to_string(l[i:], '.') AS src, array_to_string(l[i + 1:], '.') AS dst
  FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM labels)),
edges AS (
  SELECT src, dst, count(*) AS w FROM (SELECT * FROM links UNION ALL SELECT * FROM chain)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
both_ways AS (SELECT 'allow' AS kind, src, dst, w FROM edges UNION ALL SELECT 'block', dst, src, w FROM edges),
weighted AS (SELECT *, sum(w) OVER (PARTITION BY kind, src) AS total FROM both_ways),
r0 AS (SELECT kind, host, base AS score FROM seeds),{_host_sql()},
excess AS (SELECT host, sum(CASE kind WHEN 'block' THEN score ELSE -score END) AS x FROM r{ROUNDS} GROUP BY 1)
SELECT page_id, r.host, path, rule, coalesce(kind, CASE WHEN x > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN excess e ON e.host = r.host
"""
