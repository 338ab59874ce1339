"""URL filter by a path-template tree, in DataFrame operations only.

Every url has a host and a path. Rules (host, path prefix) fit a host and its subdomains, the longest wins; their
verdicts are the labels of what the tree learns about all other urls:

* per host, segments that vary are generalised into wildcards: first those that hold a digit, then, level by level
  from the root and at every level, all segments below a branch that has at least FAN different ones with few urls
  each. Branches of fewer than FAN shapes can't vary further down, so the passes end where no larger one is left.
* what other hosts know of a branch is its prior. Each host that has labels there counts once, whatever its size, with its
  share of blocked urls in thousandths, urls without a label counting half: g = (sum of shares + g above * HOSTS) / (hosts +
  HOSTS). Where these are the very hosts and shares of the branch above, g stays, since they are counted already. At the
  root g is PRIOR: that many hosts have blocked urls says nothing of a template.
* sibling branches are merged where they are shown to be alike: where a branch's share of blocked urls, or for a branch
  without labels the mean share of the other hosts, is within Z standard errors of the share of all urls below their parent.
  A branch without labels here and elsewhere is like none.
* the smoothed purity of a host's root is (blocked + g * WEIGHT) / (labelled + WEIGHT). That of a branch is
  (blocked + q * WEIGHT) / (labelled + WEIGHT) over the branches merged with it, q being g with the parent's purity in the
  place of g above; it is q itself where they hold all of the parent's labels, which are counted already, or where the
  parent has none. A branch without labels that is merged with none has g, so it takes nothing from its host: a large host
  of one blocked branch loses no other. A template is rejected where its purity reaches PURITY.

Urls are summed up by host and template before anything is joined, so a host with a third of all urls is as many
rows as it has templates. Nodes of the tree are told apart by 64-bit hashes of their paths, built up segment by segment, so
that a url of thousands of segments is as many short rows.

Defined results: null, or no "://": host and path are empty, no rule fits, judged like any other template. Repeated rows (and
repeated urls) count and are returned as often; null page_id is kept; an empty table gives no rows. Of rules of one length
that fit, the last by name wins. Only page_id and url are read, so further columns, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stash

FAN, FEW, Z, WEIGHT, HOSTS, PRIOR, PURITY = 30, 3, 1.96, 8.0, 4.0, 0.5, 0.85
#: Rows that each branch of several hosts is copied to, so that those of many hosts (as /en is) aren't one task.
SALTS = 16
#: Verdict, host and path of each rule.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_columns(rules) -> tuple[Column, Column]:
    """The longest fitting rule as host + path, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def templates(pages: DataFrame) -> DataFrame:
    """host, shape (digits generalised), template, urls, labelled, blocked."""
    t = pages.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("verdict").alias("labelled"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"))
    t = stash(t.withColumns({"done": F.lit(""), "left": F.col("shape"), "open": F.col("shape") != ""}))
    while t.where("open").limit(1).count():
        t = t.withColumn("segment", F.when(F.col("open"), F.regexp_extract("left", r"(?s)^(/[^/]*)", 1)).otherwise(""))
        child = t.where("open").groupBy("host", "done", "segment").agg(F.sum("n").alias("n"), F.count("*").alias("shapes"))
        fan = child.groupBy("host", "done").agg(((F.count("*") >= FAN) & (F.sum("n") < FEW * F.count("*"))).alias("varies"), (F.sum("shapes") >= FAN).alias("wide"))
        t = t.join(fan, ["host", "done"], "left")
        t = t.withColumn("left", F.expr("substr(left, length(segment) + 1)"))
        t = t.withColumn("done", F.concat("done", F.when(F.col("varies") & (F.col("segment") != ""), "/*").otherwise(F.col("segment"))))
        t = stash(t.withColumn("open", F.col("open") & F.col("wide") & (F.col("left") != "")).drop("varies", "wide", "segment"))
    return t.select("host", "shape", F.concat("done", "left").alias("template"), F.col("n").alias("urls"), "labelled", "blocked")


def path_nodes(template: Column) -> Column:
    """Hashes of the root and of the path's branches down to the template itself."""
    parts = F.split(template, "/")
    grow = lambda acc, s: F.array_append(acc, F.xxhash64(F.element_at(acc, -1), s))
    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), F.array(F.xxhash64(F.lit(""))), grow)


def elsewhere(node: DataFrame) -> DataFrame:
    """Adds hosts and shares: how many other hosts have labels at a node, and the sum of their shares of blocked urls."""
    share = F.when(F.col("n") > 0, F.expr("(1000 * b + 500 * (urls - n)) div urls"))
    node = node.withColumns({"share": share, "salt": F.pmod(F.xxhash64("host"), F.lit(SALTS))})
    every = node.where("parent is not null").groupBy("node").agg(F.count("*").alias("known"), F.count("share").alias("all_hosts"), F.sum("share").alias("all_shares"))
    every = every.where("known > 1 and all_hosts > 0").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("known")
    node = node.join(every.withColumn("salt", F.col("salt").cast("long")), ["node", "salt"], "left")
    own = F.coalesce("share", F.lit(0))
    hosts = F.when(F.col("all_hosts").isNull(), 0).otherwise(F.col("all_hosts") - F.col("share").isNotNull().cast("long"))
    shares = F.when(F.col("all_hosts").isNull(), 0.0).otherwise((F.col("all_shares") - own) / 1000.0)
    return node.select("host", "node", "parent", "n", "b", hosts.alias("hosts"), shares.alias("shares"))


def purities(tree: DataFrame) -> DataFrame:
    """host, template, purity."""
    leaf = stash(tree.groupBy("host", "template").agg(F.sum("urls").alias("urls"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).withColumn("path", path_nodes(F.col("template"))))
    step = leaf.select("host", "template", "urls", "labelled", "blocked", "path", F.posexplode("path").alias("depth", "node"))
    step = step.withColumn("parent", F.when(F.col("depth") > 0, F.col("path")[F.col("depth") - 1])).drop("path")
    node = stash(step.groupBy("host", "node").agg(F.min("parent").alias("parent"), F.sum("urls").alias("urls"), F.sum("labelled").alias("n"), F.sum("blocked").alias("b")))
    node = stash(elsewhere(node))
    above = node.select("host", F.col("node").alias("parent"), F.col("n").alias("all_n"), F.try_divide("b", "n").alias("rate"), F.col("hosts").alias("up_hosts"), F.col("shares").alias("up_shares"))
    n, rate, other = F.col("n"), F.col("rate"), F.col("hosts")
    near = lambda share, of: F.coalesce(F.abs(share - rate) <= Z * F.sqrt(F.try_divide(rate * (1 - rate), of)), F.lit(False))
    alike = F.when(n > 0, near(F.try_divide("b", n), n)).otherwise(near(F.try_divide("shares", other), other))
    branch = stash(node.where("parent is not null").join(above, ["host", "parent"]).withColumn("alike", alike))
    pool = branch.where("alike").groupBy("host", "parent", "alike").agg(F.sum("n").alias("pool_n"), F.sum("b").alias("pool_b"))
    about = ["hosts", "shares", "all_n", "up_hosts", "up_shares"]
    branch = branch.join(pool, ["host", "parent", "alike"], "left")
    branch = branch.select("host", "node", F.coalesce("pool_n", "n").alias("n"), F.coalesce("pool_b", "b").alias("b"), ((n > 0) | F.col("alike")).alias("shown"), *about)
    root = node.where("parent is null").withColumns({"shown": n > 0, **{c: F.lit(None).cast("double" if c == "up_shares" else "long") for c in about[2:]}})
    judged = branch.unionByName(root.drop("parent"))
    path = step.select("host", "template", "depth", "node").join(judged, ["host", "node"]).groupBy("host", "template")
    path = path.agg(F.array_sort(F.collect_list(F.struct("depth", "n", "b", "shown", *about))).alias("steps"))

    def down(at, s):
        counted = (s["hosts"] == s["up_hosts"]) & (s["shares"] == s["up_shares"])
        prior = lambda x: F.when(F.coalesce(counted, F.lit(False)), x).otherwise((s["shares"] + x * HOSTS) / (s["hosts"] + HOSTS))
        g, q = prior(at["g"]), prior(at["p"])
        p = F.when((s["all_n"] == 0) | (s["shown"] & (s["n"] == s["all_n"])), q).when(s["shown"], (s["b"] + q * WEIGHT) / (s["n"] + WEIGHT)).otherwise(g)
        return F.struct(p.alias("p"), g.alias("g"))

    fold = F.aggregate("steps", F.struct(F.lit(PRIOR).alias("p"), F.lit(PRIOR).alias("g")), down, lambda at: at["p"])
    return path.select("host", "template", fold.alias("purity"))


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, template."""
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    name, verdict = rule_columns(rules)
    base = base.withColumns({"rule": name, "verdict": verdict, "shape": F.regexp_replace("path", r"/[^/]*[0-9][^/]*", "/*")})
    base = stash(base)
    tree = stash(templates(base))
    told = tree.select("host", "shape", "template").join(purities(tree), ["host", "template"])
    out = base.join(told, ["host", "shape"])
    method = F.when(F.col("purity") >= PURITY, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "template")


def sql(rules=RULES) -> str:
    fits = {r: f"((host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}'))" for r in rules}
    longest = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2]), reverse=True)
    name = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r[1] + r[2]}'" for r in longest) + " END"
    what = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r[0]}'" for r in longest) + " END"
    return f"""
WITH RECURSIVE parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{_URL}', 1), ''), '{_UPPER}', '{_UPPER.lower()}') AS host,
                      coalesce(regexp_extract(url, '{_URL}', 2), '') AS path FROM pages),
base AS (SELECT *, {name} AS rule, {what} AS told, regexp_replace(path, '/[^/]*[0-9][^/]*', '/*', 'g') AS shape FROM parts),
t0 AS (SELECT host, shape, count(*) AS n, count(told) AS labelled, count(*) FILTER (WHERE told = 'block') AS blocked FROM base GROUP BY host, shape),
l AS (SELECT host, shape, n, labelled, blocked, '' AS done, shape AS rest FROM t0
  UNION ALL SELECT host, shape, n, labelled, blocked, done || CASE WHEN kinds >= {FAN} AND urls < {FEW} * kinds THEN '/*' ELSE segment END, substr(rest, length(segment) + 1)
  FROM (SELECT *, count(DISTINCT segment) OVER (PARTITION BY host, done) AS kinds, sum(n) OVER (PARTITION BY host, done) AS urls
        FROM (SELECT *, regexp_extract(rest, '(?s)^(/[^/]*)', 1) AS segment FROM l WHERE rest <> ''))),
tree AS (SELECT host, shape, done AS template, n AS urls, labelled, blocked FROM l WHERE rest = ''),
leaf AS (SELECT host, template, sum(urls) AS urls, sum(labelled) AS labelled, sum(blocked) AS blocked, string_split(template, '/') AS parts FROM tree GROUP BY host, template),
step AS (SELECT *, array_to_string(parts[:depth], '/') AS node, depth - 1 AS above FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS depth FROM leaf)),
node AS (SELECT host, node, depth, sum(urls) AS urls, sum(labelled) AS n, sum(blocked) AS b, any_value(array_to_string(parts[:above], '/')) AS parent FROM step GROUP BY host, node, depth),
shares AS (SELECT *, CASE WHEN n > 0 AND depth > 1 THEN (1000 * b + 500 * (urls - n)) // urls END AS share FROM node),
others AS (SELECT *, count(share) OVER w - CASE WHEN share IS NULL THEN 0 ELSE 1 END AS hosts, (coalesce(sum(share) OVER w, 0) - coalesce(share, 0))::DOUBLE / 1000 AS shares
           FROM shares WINDOW w AS (PARTITION BY node, depth)),
rated AS (SELECT c.host, c.node, c.depth, c.parent, c.n, c.b, c.hosts, c.shares, p.n AS all_n, p.hosts AS up_hosts, p.shares AS up_shares, p.b::DOUBLE / nullif(p.n, 0) AS rate,
            CASE WHEN c.n > 0 THEN c.b::DOUBLE / c.n ELSE c.shares / nullif(c.hosts, 0) END AS own, CASE WHEN c.n > 0 THEN c.n ELSE nullif(c.hosts, 0) END AS times
          FROM others c JOIN others p ON c.host = p.host AND c.parent = p.node AND c.depth = p.depth + 1),
near AS (SELECT *, coalesce(abs(own - rate) <= {Z} * sqrt(rate * (1 - rate) / times), false) AS alike FROM rated),
branch AS (SELECT host, node, depth, parent, all_n, hosts, shares, n > 0 OR alike AS shown, hosts = up_hosts AND shares = up_shares AS counted,
             CASE WHEN alike THEN sum(n) OVER w ELSE n END AS n, CASE WHEN alike THEN sum(b) OVER w ELSE b END AS b
           FROM near WINDOW w AS (PARTITION BY host, parent, depth, alike)),
pure AS (SELECT host, node, depth, CASE WHEN n > 0 THEN (b::DOUBLE + g * {WEIGHT}) / (n::DOUBLE + {WEIGHT}) ELSE g END AS purity, g
         FROM (SELECT *, (shares + {PRIOR * HOSTS}) / (hosts::DOUBLE + {HOSTS}) AS g FROM others WHERE depth = 1)
  UNION ALL SELECT host, node, depth, CASE WHEN all_n = 0 OR (shown AND n = all_n) THEN q WHEN shown THEN (b::DOUBLE + q * {WEIGHT}) / (n::DOUBLE + {WEIGHT}) ELSE g END, g
  FROM (SELECT c.*, CASE WHEN c.counted THEN p.g ELSE (c.shares + p.g * {HOSTS}) / (c.hosts::DOUBLE + {HOSTS}) END AS g,
          CASE WHEN c.counted THEN p.purity ELSE (c.shares + p.purity * {HOSTS}) / (c.hosts::DOUBLE + {HOSTS}) END AS q
        FROM pure p JOIN branch c ON c.host = p.host AND c.parent = p.node AND c.depth = p.depth + 1))
SELECT b.page_id, b.host, b.path, b.rule, coalesce(b.told, CASE WHEN j.purity >= {PURITY} THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM base b JOIN tree t ON b.host = t.host AND b.shape = t.shape JOIN leaf f ON f.host = t.host AND f.template = t.template
JOIN pure j ON j.host = f.host AND j.node = f.template AND j.depth = len(f.parts)
"""
