"""URL filter: a path-template tree per host, judged by smoothed labelled purity, under explicit host and path rules.

Level by level, the path segments below a node (host and template so far) are generalised. A segment that is not frequent
(``MIN_PAGES`` pages and ``MIN_SHARE`` of the node's) stays apart, as a branch of its own, if it has ``MIN_LABELLED`` labelled pages,
however small its share, and its share of bad pages differs from that of the node's rest (two-proportion test, ``Z``). The
others are variable: together they are the wildcard ``*``. The frequent ones, at most 1 / MIN_SHARE of them, and the wildcard
stand in the order of their share of bad pages; neighbours whose shares do not differ (same test) merge into one branch. The
branch with the wildcard, else the one with most pages, is ``*``; another branch is named by its segment, or ``{a|b}`` if it has several. Templates whose labelled share of bad pages, smoothed towards
the host's and that towards the corpus's, reaches ``BLOCK_AT`` are rejected; one without labels never is.

The tree goes on while a node has ``MIN_PAGES`` pages with a further segment; below that all segments are variable. A template
has a place for every segment, so paths of different depth never share one.

Levels only aggregate over pages; the literal branches are a small table per level that is joined to the rows, so a host
with a third of all pages is neither gathered nor shuffled, and the test of its rare segments needs only the two sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.common import az_lower, bounded, table, written

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
#: Levels between two written copies of the rows, and levels of the SQL.
LEVELS = 8
MIN_PAGES, MIN_SHARE, Z = 10, 0.05, 3.0
#: Labelled pages that a segment below ``MIN_SHARE`` needs to be tested.
MIN_LABELLED = 10
PRIOR, BLOCK_AT = 10.0, 0.5


def parsed(pages: DataFrame, url: Column) -> DataFrame:
    """Add host and path. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there
    up to ``?``, ``#`` or the end. A null url or one without ``://`` has neither (both empty)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return pages.withColumn("host", F.coalesce(az_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.lit(""))).withColumn(
        "path", F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits: its host is the url's or a parent domain of it, its path a prefix of the url's path."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _segments(path: Column) -> Column:
    """Path segments without the empty ones."""
    return F.array_remove(F.split(path, "/"), "")


def _step(rows: DataFrame, level: int, named: DataFrame) -> DataFrame:
    """Extend ``template`` by the level's branch: the segment's if it has a name, else the wildcard."""
    seg = F.get("_segs", F.lit(level))
    rows = rows.join(named, (rows["host"] == F.col("_host")) & (rows["template"] == F.col("_tpl")) & (seg == F.col("_seg")), "left")
    more = F.when(seg.isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.coalesce("_name", F.lit("*"))))
    rows = rows.withColumn("template", F.concat("template", more)).drop("_host", "_tpl", "_seg", "_name")
    return written(rows, "deeper-paths") if (level + 1) % LEVELS == 0 else rows  # so that a plan has few joins


def _ended(rows: DataFrame, level: int) -> DataFrame:
    """Complete ``template`` by wildcards for the segments from ``level`` on, which have no branches."""
    more = F.repeat(F.lit("/*"), F.greatest(F.size("_segs") - level, F.lit(0)))
    return rows.withColumn("template", F.concat("template", more))


def _apart(bad: Column, lab: Column, bad0: Column, lab0: Column) -> Column:
    """Whether two shares of bad pages differ; not without labels on either side."""
    all_ = F.try_divide(bad + bad0, lab + lab0)
    se = F.sqrt(all_ * (1 - all_) * (F.try_divide(F.lit(1), lab) + F.try_divide(F.lit(1), lab0)))
    return F.coalesce(F.abs(F.try_divide(bad, lab) - F.try_divide(bad0, lab0)) > Z * se, F.lit(False))


def _branches(child: DataFrame) -> DataFrame:
    """(_host, _tpl, _seg, _name) of the segments outside the wildcard branch, from a node's few frequent segments and its rest
    (``_seg`` null), each with n, lab and bad."""
    order = W.partitionBy("_host", "_tpl").orderBy("_rate", F.col("_seg").asc_nulls_first())
    child = child.withColumn("_rate", F.try_divide("bad", "lab"))
    l0, b0 = F.lag("lab").over(order), F.lag("bad").over(order)
    child = child.withColumn("_apart", _apart(F.col("bad"), F.col("lab"), b0, l0).cast("int"))
    child = child.withColumn("_class", F.sum("_apart").over(order.rowsBetween(W.unboundedPreceding, 0)))
    names = child.groupBy("_host", "_tpl", "_class").agg(
        F.sum("n").alias("_pages"), F.max(F.col("_seg").isNull()).alias("_wild"), F.sort_array(F.collect_list("_seg")).alias("_all"))
    top = F.row_number().over(W.partitionBy("_host", "_tpl").orderBy(F.desc("_wild"), F.desc("_pages"), "_class"))
    names = names.withColumn("_top", top).filter("_top > 1")
    name = F.when(F.size("_all") == 1, F.get("_all", F.lit(0))).otherwise(F.concat(F.lit("{"), F.array_join("_all", "|"), F.lit("}")))
    return names.select("_host", "_tpl", F.explode("_all").alias("_seg"), name.alias("_name"))


def template_tree(pages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """From pages (host, path, bad), bad being 0, 1 or null (no label): the literal branches of each level, and all
    templates (host, template, n, labelled, bad_share, blocked)."""
    per = pages.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    rows = written(per.withColumn("_segs", _segments(F.col("path"))).withColumn("template", F.lit("")).drop("path"), "paths")
    levels = []
    while True:
        level = len(levels)
        here = rows.withColumn("_seg", F.get("_segs", F.lit(level))).filter("_seg is not null")
        sums = [F.sum(c).alias(c) for c in ("n", "lab", "bad")]
        node = here.groupBy(F.col("host").alias("_host"), F.col("template").alias("_tpl")).agg(*sums)
        node = written(node.filter(F.col("n") >= MIN_PAGES), "nodes")
        if node.isEmpty():  # no node below has as many pages either
            break
        child = here.groupBy("host", "template", "_seg").agg(*sums).filter(F.col("n") >= MIN_PAGES).withColumnsRenamed({"n": "_n", "lab": "_lab", "bad": "_bad"})
        both = child.join(bounded(node), (F.col("host") == F.col("_host")) & (F.col("template") == F.col("_tpl")))
        differs = _apart(F.col("_bad"), F.col("_lab"), F.col("bad") - F.col("_bad"), F.col("lab") - F.col("_lab"))
        both = both.withColumn("_often", F.col("_n") >= F.col("n") * MIN_SHARE)
        both = written(both.filter(F.col("_often") | ((F.col("_lab") >= MIN_LABELLED) & differs)), "candidate-segments")
        rest = both.groupBy("_host", "_tpl").agg(*[(F.first(c) - F.sum("_" + c)).alias(c) for c in ("n", "lab", "bad")]).filter("n > 0")
        own = both.filter("_often").select("_host", "_tpl", "_seg", F.col("_n").alias("n"), F.col("_lab").alias("lab"), F.col("_bad").alias("bad"))
        named = _branches(own.unionByName(rest.withColumn("_seg", F.lit(None).cast("string"))))
        named = named.unionByName(both.filter("not _often").select("_host", "_tpl", "_seg", F.col("_seg").alias("_name")))
        kept = bounded(written(named, "branches"))
        levels.append(kept)
        rows = _step(rows, level, kept)
    leaves = _ended(rows, len(levels)).groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("lab").alias("labelled"), F.sum("bad").alias("bad"))
    leaves = written(leaves, "templates")
    total = leaves.agg(F.sum("bad"), F.sum("labelled")).first()
    base = (total[0] or 0) / total[1] if total[1] else 0.0
    hosts = leaves.groupBy(F.col("host").alias("_host")).agg(((F.sum("bad") + PRIOR * base) / (F.sum("labelled") + PRIOR)).alias("_rate"))
    share = (F.col("bad") + PRIOR * F.col("_rate")) / (F.col("labelled") + PRIOR)
    judged = leaves.join(hosts, leaves["host"] == F.col("_host")).select("host", "template", "n", "labelled", share.alias("bad_share"))
    return levels, judged.withColumn("blocked", (F.col("labelled") > 0) & (F.col("bad_share") >= BLOCK_AT))


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template) for every row of ``pages(page_id, url)``.

    ``labels(page_id, bad)`` marks some pages as bad (1) or good (0); several labels of a page count as their worst. The
    verdict is the longest fitting rule's, else block for a rejected template and allow otherwise. Null and broken urls
    share the empty host and template; repeated rows all stay; without labels the tree rejects nothing.
    """
    marks = labels.filter("page_id is not null").groupBy(F.col("page_id").alias("_page")).agg(F.max("bad").cast("long").alias("bad"))
    rows = parsed(pages.select("page_id", "url"), F.col("url")).drop("url")
    marked = rows.join(marks, rows["page_id"] == F.col("_page"), "left")
    levels, judged = template_tree(marked.select("host", "path", "bad"))
    rows = rows.withColumn("_segs", _segments(F.col("path"))).withColumn("template", F.lit(""))
    for level, kept in enumerate(levels):
        rows = _step(rows, level, kept)
    rows = _ended(rows, len(levels))
    bad = bounded(written(judged.filter("blocked").select(F.col("host").alias("_host"), F.col("template").alias("_tpl")), "rejected-templates"))
    rows = rows.join(bad, (rows["host"] == F.col("_host")) & (rows["template"] == F.col("_tpl")), "left")
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    by_rule = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in r]), rule) if rules else F.lit(None).cast("string")
    verdict = F.coalesce(by_rule, F.when(F.col("_host").isNotNull(), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "template")


def labels_of_pages(labels: DataFrame) -> DataFrame:
    """The driver's document labels as page labels: a page is bad if the document of its number is poor or toxic."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    return labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))


def q_op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged by the rules and the labelled template tree."""
    return filter_urls(table(spark, sf_dir, "pages"), labels_of_pages(table(spark, sf_dir, "labels")))


def _oracle() -> str:
    """The same tree, unrolled over ``LEVELS`` levels and without the rare segments that stay apart: the test tables have
    neither deeper paths nor such segments."""
    fits = lambda r: f"(host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}')"
    by_len = sorted(RULES, key=lambda r: -len(r[0]))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in by_len) + " END"
    said = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{v}'" for r, v in by_len) + " END"
    q = [r"""WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
g AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM h),
l AS (SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
"""
         f"r0 AS (SELECT g.page_id, host, path, bad, '' AS tpl, CASE WHEN len(s) > {LEVELS} THEN list_concat(list_slice(s, 1, {LEVELS - 1}), "
         f"[array_to_string(list_slice(s, {LEVELS}, len(s)), '/')]) ELSE s END AS s FROM g LEFT JOIN l ON l.doc_id = g.page_id)"]
    for k in range(LEVELS):
        q.append(f"""n{k} AS (SELECT host, tpl, count(*) AS n, count(bad) AS lab, coalesce(sum(bad), 0) AS bad FROM r{k} WHERE len(s) > {k} GROUP BY ALL),
f{k} AS (SELECT c.* FROM (SELECT host, tpl, s[{k + 1}] AS seg, count(*) AS n, count(bad) AS lab, coalesce(sum(bad), 0) AS bad
  FROM r{k} WHERE len(s) > {k} GROUP BY ALL) c JOIN n{k} n ON c.host = n.host AND c.tpl = n.tpl WHERE c.n >= {MIN_PAGES} AND c.n >= n.n * {MIN_SHARE}),
c{k} AS (SELECT * FROM f{k} UNION ALL SELECT n.host, n.tpl, NULL, n.n - f.n, n.lab - f.lab, n.bad - f.bad FROM n{k} n
  JOIN (SELECT host, tpl, sum(n) AS n, sum(lab) AS lab, sum(bad) AS bad FROM f{k} GROUP BY ALL) f ON f.host = n.host AND f.tpl = n.tpl WHERE n.n > f.n),
d{k} AS (SELECT *, lag(lab) OVER w AS l0, lag(bad) OVER w AS b0, row_number() OVER w AS o FROM c{k}
  WINDOW w AS (PARTITION BY host, tpl ORDER BY CASE WHEN lab > 0 THEN bad / lab::DOUBLE END NULLS FIRST, seg NULLS FIRST)),
e{k} AS (SELECT *, sum(CASE WHEN l0 > 0 AND lab > 0 AND abs(bad / lab::DOUBLE - b0 / l0::DOUBLE)
    > {Z} * sqrt((bad + b0) / (lab + l0)::DOUBLE * (1 - (bad + b0) / (lab + l0)::DOUBLE) * (1 / lab::DOUBLE + 1 / l0::DOUBLE)) THEN 1 ELSE 0 END)
  OVER (PARTITION BY host, tpl ORDER BY o) AS class FROM d{k}),
m{k} AS (SELECT *, row_number() OVER (PARTITION BY host, tpl ORDER BY wild DESC, pages DESC, class) AS top FROM (
  SELECT host, tpl, class, sum(n) AS pages, max(CASE WHEN seg IS NULL THEN 1 ELSE 0 END) AS wild,
  string_agg(seg, '|' ORDER BY seg) AS names, count(seg) AS many FROM e{k} GROUP BY ALL)),
k{k} AS (SELECT e.host, e.tpl, e.seg, CASE WHEN many > 1 THEN '{{' || names || '}}' ELSE names END AS name
  FROM e{k} e JOIN m{k} m ON e.host = m.host AND e.tpl = m.tpl AND e.class = m.class WHERE top > 1),
r{k + 1} AS (SELECT page_id, r.host, path, bad, CASE WHEN len(s) > {k} THEN r.tpl || '/' || coalesce(k.name, '*') ELSE r.tpl END AS tpl, s
  FROM r{k} r LEFT JOIN k{k} k ON r.host = k.host AND r.tpl = k.tpl AND r.s[{k + 1}] = k.seg)""")
    q.append(f"""t AS (SELECT host, tpl, count(bad) AS lab, coalesce(sum(bad), 0) AS bad FROM r{LEVELS} GROUP BY ALL),
b AS (SELECT coalesce(sum(bad) / sum(lab)::DOUBLE, 0) AS base FROM t),
hr AS (SELECT host, (sum(bad) + {PRIOR} * (SELECT base FROM b)) / (sum(lab) + {PRIOR}) AS rate FROM t GROUP BY host),
x AS (SELECT t.host, t.tpl, (t.bad + {PRIOR} * rate) / (t.lab + {PRIOR}) >= {BLOCK_AT} AND t.lab > 0 AS blocked FROM t JOIN hr ON t.host = hr.host)
SELECT page_id, r.host, path, {rule.replace('host', 'r.host')} AS rule,
  coalesce({said.replace('host', 'r.host')}, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict, r.tpl AS template
FROM r{LEVELS} r JOIN x ON r.host = x.host AND r.tpl = x.tpl""")
    return ",\n".join(q)


ORACLE_OP1 = _oracle()
