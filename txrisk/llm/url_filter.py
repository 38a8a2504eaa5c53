"""URL filter by a path-template tree per host (operator 4), with DataFrame functions only.

A url is first judged by allow and block rules for a host with its subdomains and a path prefix. The urls that
a rule has judged are the labelled ones. Per host, path segments that recur at their place stay literal and the
others become wildcards, which turns paths into templates, the leaves of the host's tree. Level by level from a
leaf up, a branch whose block rate is statistically like its parent's is merged with its like siblings. The block
rate of what a leaf is merged into, smoothed towards the same template's on all hosts, rejects a template; one
with too few labels among its rows, or whose labels elsewhere come from a single rule, is not rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, read_table

#: Fixed values of the contract: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: A segment stays literal if it has one in so many rows of its host and place and at least two, or so many rows
#: as a variable one hardly has, however large the host.
LITERAL_SHARE = 20
LITERAL_ROWS = 20
#: A branch differs from its parent beyond this squared z value (5 % level).
MERGE_Z2 = 3.84
#: Block rate of a template without any labels, at most.
NO_LABELS = 0.49
#: Labels that the prior counts for, and the smoothed block rate that rejects.
SMOOTHING = 5.0
REJECT = 0.5
#: Hot hosts and templates are joined in so many parts.
SALTS = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _salted_join(rows: DataFrame, nodes: DataFrame, keys: list[str], spread: Column) -> DataFrame:
    """Left join of many rows to one node per key; a hot key's rows go to SALTS tasks."""
    left = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    right = nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [*keys, "salt"], "left").drop("salt")


def templates(rows: DataFrame) -> DataFrame:
    """``rows`` (rid, host, path, …) with ``tokens``: literal segments, and ``*`` for variable ones.

    A wildcard keeps the segment's extension. Empty segments, as after a closing slash, count like any other.
    """
    segments = F.slice(F.split("path", "/", -1), 2, 2**31 - 1)
    places = rows.select("rid", "host", F.posexplode(segments).alias("place", "segment"))
    seen = places.groupBy("host", "place", "segment").agg(F.count("*").alias("c"))
    total = seen.groupBy("host", "place").agg(F.sum("c").alias("total"))
    often = _salted_join(seen.where("c >= 2"), total, ["host", "place"], F.col("segment"))
    literal = often.where((F.col("c") * LITERAL_SHARE >= F.col("total")) | (F.col("c") >= LITERAL_ROWS)).select("host", "place", "segment", F.lit(True).alias("literal"))
    wild = F.concat(F.lit("*"), F.lower(F.regexp_extract("segment", r"(\.[A-Za-z]{1,5})$", 1)))
    named = _salted_join(places, literal, ["host", "place", "segment"], F.col("rid")).withColumn("token", F.when(F.col("literal"), F.col("segment")).otherwise(wild))
    tokens = named.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("t")).select(F.col("rid").alias("r"), F.col("t.token").alias("tokens"))
    return rows.join(tokens, F.col("rid") == F.col("r"), "left").drop("r").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))


def merged_nodes(leaves: DataFrame) -> DataFrame:
    """host, template, rows, n, bad of what every leaf is merged into, from leaves (host, template, tokens, rows, n, bad)."""
    prefix = lambda j: F.concat_ws("/", F.lit(""), F.slice("tokens", F.lit(1), j))
    level = F.explode(F.expr("CASE WHEN size(tokens) > 0 THEN sequence(1, size(tokens)) END")).alias("level")
    steps = leaves.select("*", level).withColumn("node", prefix(F.col("level"))).withColumn("parent", prefix(F.col("level") - 1))
    steps = materialize(steps.drop("tokens"), "op4-steps")
    sums = [F.sum(c).alias(c) for c in ("rows", "n", "bad")]
    nodes = steps.groupBy("host", "level", "node", "parent").agg(*sums)
    parents = nodes.groupBy("host", "level", "parent").agg(F.sum("n").alias("up_n"), F.sum("bad").alias("up_bad"))
    nodes = _salted_join(nodes, parents, ["host", "level", "parent"], F.col("node"))
    p = (F.col("up_bad") + 0.5) / (F.col("up_n") + 1.0)
    off = F.col("bad") - F.col("n") * p
    # Without labels of its own a branch is like nothing.
    alike = (F.col("n") > 0) & (off * off <= F.lit(MERGE_Z2) * (F.col("n") * p * (1 - p)))
    nodes = materialize(nodes.select("host", "level", "node", "parent", "rows", "n", "bad", alike.alias("alike")), "op4-nodes")
    like = nodes.where("alike").groupBy("host", "level", "parent").agg(*[F.sum(c).alias("like_" + c) for c in ("rows", "n", "bad")])
    nodes = _salted_join(nodes, like, ["host", "level", "parent"], F.col("node"))
    nodes = nodes.select("host", "level", "node", "alike", "like_rows", "like_n", "like_bad")
    chain = _salted_join(steps, nodes, ["host", "level", "node"], F.col("template"))
    # From the leaf up, as long as the branch is like its parent.
    climb = """aggregate(reverse(sort_array(collect_list(struct(level, alike, like_rows, like_n, like_bad)))),
      named_struct('open', true, 'rows', first(rows), 'n', first(n), 'bad', first(bad)),
      (s, x) -> if(s.open and x.alike, named_struct('open', true, 'rows', x.like_rows, 'n', x.like_n, 'bad', x.like_bad),
                   named_struct('open', false, 'rows', s.rows, 'n', s.n, 'bad', s.bad)))"""
    met = chain.groupBy("host", "template").agg(F.expr(climb).alias("m")).select("host", "template", "m.rows", "m.n", "m.bad")
    # Paths without segments are the root, which has no parent.
    return met.unionByName(leaves.where(F.size("tokens") == 0).select("host", "template", "rows", "n", "bad"))


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, block_rate: one row per input row.

    Null urls and urls without ``://`` have empty host and path. Repeated rows and null ids are judged like any
    other row; an empty table gives an empty result; other columns are not read. Where no url has a rule every
    template passes.
    """
    cols = pages.select(F.col("page_id"), F.col("url").cast("string").alias("__url"))
    cols = cols.select("page_id", host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = cols.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("rid", F.monotonically_increasing_id())
    # Written with their numbers, by which the segments come back to them.
    rows = materialize(rows, "op4-urls")
    rows = materialize(templates(rows).withColumn("template", F.concat_ws("/", F.lit(""), "tokens")), "op4-rows")

    labelled = F.count("*").alias("rows"), F.count("ruled").alias("n"), F.count(F.when(F.col("ruled") == "block", 1)).alias("bad")
    leaves = materialize(rows.groupBy("host", "template", "tokens").agg(*labelled), "op4-leaves")
    anywhere = rows.groupBy("template", "rule").agg(*labelled).groupBy("template").agg(
        F.sum("rows").alias("all_rows"), F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"), F.count("rule").alias("rules"),
    )
    overall = leaves.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    base = F.lit(min(NO_LABELS, (overall["bad"] + 0.5) / (overall["n"] + 1.5)))

    nodes = _salted_join(merged_nodes(leaves), anywhere, ["template"], F.col("host"))
    # What a template is worth elsewhere counts if more than one rule says so, about most of its rows.
    heard = (F.col("rules") > 1) & (2 * F.col("all_n") >= F.col("all_rows"))
    prior = F.when(heard, (F.col("all_bad") + SMOOTHING * base) / (F.col("all_n") + SMOOTHING)).otherwise(base)
    own = 2 * F.col("n") >= F.col("rows")
    n, bad = (F.when(own, F.col(c)).otherwise(0) for c in ("n", "bad"))
    nodes = nodes.select("host", "template", ((bad + SMOOTHING * prior) / (n + SMOOTHING)).alias("block_rate"))
    out = _salted_join(rows, nodes, ["host", "template"], F.col("path"))
    rejected = F.when(F.col("block_rate") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", rejected).alias("verdict"), "template", F.round("block_rate", 9).alias("block_rate"))


def op4_url_filter(spark, sf_dir):
    return judge_urls(read_table(spark, sf_dir, "pages"))


def _rule_sql(column: int) -> str:
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, kind)[column]}'"
        for kind, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    )
    return f"CASE {cases} END"


ORACLE_SQL = rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{_URL}', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '{_URL}', 2), '') AS path
  FROM pages
), r AS (
  SELECT *, {_rule_sql(0)} AS rule, {_rule_sql(1)} AS ruled, string_split(path, '/')[2:] AS segments, row_number() OVER () AS rid FROM u
), places AS (
  SELECT rid, host, unnest(segments) AS segment, generate_subscripts(segments, 1) AS place FROM r
), literal AS (
  SELECT host, place, segment FROM (
    SELECT *, sum(c) OVER (PARTITION BY host, place) AS n
    FROM (SELECT host, place, segment, count(*) AS c FROM places GROUP BY host, place, segment)
  ) WHERE c >= 2 AND (c * {LITERAL_SHARE} >= n OR c >= {LITERAL_ROWS})
), tokens AS (
  SELECT rid, list(CASE WHEN l.segment IS NOT NULL THEN p.segment
                        ELSE '*' || lower(regexp_extract(p.segment, '(\.[A-Za-z]{{1,5}})$', 1)) END ORDER BY p.place) AS tokens
  FROM places p LEFT JOIN literal l ON p.host = l.host AND p.place = l.place AND p.segment = l.segment GROUP BY rid
), t AS (
  SELECT r.*, coalesce(tokens, []) AS tokens, CASE WHEN tokens IS NULL THEN '' ELSE '/' || array_to_string(tokens, '/') END AS template
  FROM r LEFT JOIN tokens USING (rid)
), leaves AS (
  SELECT host, template, tokens, count(*) AS rows, count(ruled) AS n, count(CASE WHEN ruled = 'block' THEN 1 END) AS bad FROM t GROUP BY host, template, tokens
), overall AS (
  SELECT least({NO_LABELS}::DOUBLE, (coalesce(sum(bad), 0)::DOUBLE + 0.5::DOUBLE) / (coalesce(sum(n), 0)::DOUBLE + 1.5::DOUBLE)) AS base FROM leaves
), steps AS (
  SELECT host, template, rows, n, bad, level, array_to_string(list_prepend('', tokens[:level]), '/') AS node,
         CASE WHEN level = 1 THEN '' ELSE array_to_string(list_prepend('', tokens[:level - 1]), '/') END AS parent
  FROM (SELECT *, unnest(range(1, len(tokens) + 1)) AS level FROM leaves)
), nodes AS (
  SELECT host, level, node, parent, sum(rows) AS rows, sum(n) AS n, sum(bad) AS bad FROM steps GROUP BY host, level, node, parent
), rated AS (
  SELECT *, (sum(bad) OVER (PARTITION BY host, level, parent)::DOUBLE + 0.5::DOUBLE) / (sum(n) OVER (PARTITION BY host, level, parent)::DOUBLE + 1.0::DOUBLE) AS p FROM nodes
), judged AS (
  SELECT *, n > 0 AND (bad::DOUBLE - n::DOUBLE * p) * (bad::DOUBLE - n::DOUBLE * p) <= {MERGE_Z2}::DOUBLE * (n::DOUBLE * p * (1::DOUBLE - p)) AS alike FROM rated
), pooled AS (
  SELECT host, level, node, alike, sum(CASE WHEN alike THEN rows END) OVER w AS like_rows, sum(CASE WHEN alike THEN n END) OVER w AS like_n,
         sum(CASE WHEN alike THEN bad END) OVER w AS like_bad
  FROM judged WINDOW w AS (PARTITION BY host, level, parent)
), chain AS (
  SELECT s.host, s.template, s.rows, s.n, s.bad, s.level, q.alike, q.like_rows, q.like_n, q.like_bad,
         bool_and(q.alike) OVER (PARTITION BY s.host, s.template ORDER BY s.level DESC) AS open
  FROM steps s JOIN pooled q ON q.host = s.host AND q.level = s.level AND q.node = s.node
), met AS (
  SELECT host, template, coalesce(arg_min(like_rows, level) FILTER (WHERE open), any_value(rows)) AS rows,
         coalesce(arg_min(like_n, level) FILTER (WHERE open), any_value(n)) AS n, coalesce(arg_min(like_bad, level) FILTER (WHERE open), any_value(bad)) AS bad
  FROM chain GROUP BY host, template
  UNION ALL
  SELECT host, template, rows, n, bad FROM leaves WHERE len(tokens) = 0
), anywhere AS (
  SELECT template, count(*) AS all_rows, count(ruled) AS all_n, count(CASE WHEN ruled = 'block' THEN 1 END) AS all_bad, count(DISTINCT rule) AS rules FROM t GROUP BY template
), rates AS (
  SELECT host, m.template,
         ((CASE WHEN 2 * n >= rows THEN bad ELSE 0 END)::DOUBLE + {SMOOTHING}::DOUBLE * prior) / ((CASE WHEN 2 * n >= rows THEN n ELSE 0 END)::DOUBLE + {SMOOTHING}::DOUBLE) AS block_rate
  FROM (SELECT m.*, CASE WHEN rules > 1 AND 2 * all_n >= all_rows THEN (all_bad::DOUBLE + {SMOOTHING}::DOUBLE * base) / (all_n::DOUBLE + {SMOOTHING}::DOUBLE) ELSE base END AS prior
        FROM met m JOIN anywhere a ON a.template = m.template, overall) m
)
SELECT page_id, t.host, path, rule, coalesce(ruled, CASE WHEN block_rate >= {REJECT}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
       t.template, round(block_rate, 9) AS block_rate
FROM t JOIN rates ON t.host = rates.host AND t.template = rates.template
"""
