"""URL filters: a tree of path templates for each host, whose templates are judged by their labelled rows.

Rules judge the URLs that they fit, and what they say labels rows; a label column may label more.
All other URLs are judged by their template:

1. Within the row, numbers and long hexadecimal strings of a path become `#`. Rows are then counted
   by host and shaped path, before anything else moves; these are the leaves of the tree.
2. Level by level, a node with more than `fanout` children is variable there: children with less
   than the share `common` of its rows become the wildcard `#*`.
3. Branches of a node with at least `evidence` labelled rows stand in order of their share of
   blocked ones; neighbours that a test of two shares can't tell apart merge into `#{a|b}`.
   Branches without such evidence stay on their own, so that they inherit nothing.
4. A template is rejected if (blocked + 1) / (labelled + 2) reaches `reject`: without labels that is
   1/2, and two blocked rows alone aren't enough.

`#` cannot stand in a path, so wildcards are never taken for segments. After the first step, only
counts move. Verdicts go back to rows by a join on the leaf; leaves that hold more than a
thousandth of the rows, at most a thousand by that, are broadcast, and their rows pass the
join of the others dealt out evenly. No group is gathered: a node is a partial aggregate, and the one
window, over a node's branches, sees at most max(fanout, 1 / common) + 1 rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenhand.llm.common import fresh, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a URL's id-like parts are: long hexadecimal strings and numbers.
VARIABLE = "[0-9a-fA-F]{16,}|[0-9]+"
HEAVY = 1000  # leaves with more than 1 / HEAVY of the rows are broadcast


@dataclass(frozen=True)
class Settings:
    """See the module's text. Segments beyond `levels` are shaped, but neither generalised nor merged."""

    fanout: int = 20
    common: float = 0.05
    evidence: int = 3
    chi_square: float = 3.84
    reject: float = 0.8
    levels: int = 8


@dataclass(frozen=True)
class Rule:
    """Allows or blocks the URLs of `host` and its subdomains whose path starts with `path`."""

    host: str
    path: str
    allow: bool

    @classmethod
    def of(cls, line: str) -> Rule:
        """From `allow host/path` or `block host/path`."""
        verdict, place = line.split(" ", 1)
        if verdict not in ("allow", "block") or "/" not in place:
            raise ValueError(f"a rule is `allow host/path` or `block host/path`, not {line!r}")
        host, path = place.split("/", 1)
        return cls(host.translate(str.maketrans(UPPER, LOWER)), f"/{path}", verdict == "allow")

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty for null and where there is no `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """name and allow of the longest rule that fits, of equally long ones one that blocks; null if none fits."""
    found = [F.when(r.fits(host, path), F.struct(F.lit(r.name).alias("name"), F.lit(r.allow).alias("allow"))) for r in sorted(rules, key=lambda r: (-len(r.name), r.allow, r.name))]
    return F.coalesce(*found, F.lit(None).cast("struct<name: string, allow: boolean>"))


def _branches(children: DataFrame, s: Settings) -> DataFrame:
    """host, parent, name and into: what branches of a node are called once similar ones are merged."""
    labelled = F.col("good") + F.col("bad")
    known = children.filter(labelled >= s.evidence).withColumn("share", F.col("bad") / labelled)
    siblings = Window.partitionBy("host", "parent").orderBy("share", "name")
    for c in ("good", "bad"):
        known = known.withColumn(f"{c}_before", F.lag(c).over(siblings))
    n, m = F.col("good") + F.col("bad"), F.col("good_before") + F.col("bad_before")
    bad, good = F.col("bad") + F.col("bad_before"), F.col("good") + F.col("good_before")
    # the squared difference of two shares over its variance under one pooled share, multiplied out
    distance = F.col("bad") * m - F.col("bad_before") * n
    apart = distance.cast("double") * distance * (n + m) > F.lit(s.chi_square) * bad * good * n * m
    known = known.withColumn("cluster", F.sum(F.coalesce(apart, F.lit(False)).cast("int")).over(siblings))
    members = Window.partitionBy("host", "parent", "cluster")
    names = F.sort_array(F.collect_set("name").over(members))
    into = F.when(F.size(names) > 1, F.concat(F.lit("#{"), F.array_join(names, "|"), F.lit("}"))).otherwise(F.col("name"))
    return known.select("host", "parent", "name", into.alias("into"))


def _generalised(leaves: DataFrame, level: int, s: Settings) -> DataFrame:
    """`leaves` with the segments of `level` (from 1) generalised and merged."""
    at = ["host", "parent", "segment"]
    here = leaves.withColumns({"parent": F.array_join(F.slice("template", 1, level - 1), "/"), "segment": F.get("template", F.lit(level - 1))})
    children = here.filter(F.size("template") >= level).groupBy(*at).agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    wide = children.groupBy("host", "parent").agg(F.sum("n").alias("total"), F.count("*").alias("fan")).filter(F.col("fan") > s.fanout).drop("fan")
    named = children.join(wide, ["host", "parent"], "left").withColumn("name", F.when(F.col("n") < F.lit(s.common) * F.col("total"), "#*").otherwise(F.col("segment")))
    merged = _branches(named.groupBy("host", "parent", "name").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), s)
    named = named.join(merged, ["host", "parent", "name"], "left").withColumn("into", F.coalesce("into", "name"))
    changed = named.filter("into <> segment").select(*at, "into")
    rest = F.slice("template", level + 1, F.greatest(F.size("template") - level, F.lit(0)))
    template = F.when(F.col("into").isNull(), F.col("template")).otherwise(F.concat(F.slice("template", 1, level - 1), F.array("into"), rest))
    return here.join(changed, at, "left").select("host", "shape", "n", "good", "bad", template.alias("template"))


def templates(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """host, shape, n, template, labelled, bad and rejected for each shaped path of rows (host, shape, allow).

    labelled and bad are those of the whole template, n is the shape's own number of rows.
    """
    allow = F.col("allow")
    counts = rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count_if(allow).alias("good"), F.count_if(~allow).alias("bad"))
    parts = F.split("shape", "/")
    leaves = stored(counts.withColumn("template", F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))))
    deepest = leaves.agg(F.max(F.size("template"))).first()[0] or 0
    for level in range(1, min(deepest, s.levels) + 1):
        leaves = stored(_generalised(leaves, level, s))
    leaves = leaves.withColumn("template", F.concat(F.lit("/"), F.array_join("template", "/")))
    # one leaf is a template of its own at worst: the sums are as many as the leaves at most
    sums = leaves.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum(F.col("good") + F.col("bad")).alias("labelled"))
    rejected = (F.col("bad") + 1) / (F.col("labelled") + 2) >= s.reject
    return leaves.select("host", "shape", "n", "template").join(sums.withColumn("rejected", rejected), ["host", "template"])


def judged(df: DataFrame, url: str = "url", rules: Sequence[Rule] = (), label: str | None = None, out: str = "url_filter", settings: Settings = Settings()) -> DataFrame:
    """`df` with a struct column `out`: host, path, rule, template, labelled, bad, verdict (allow or block).

    `label` names a boolean column, true where a URL is good; where a rule fits, the rule's verdict
    stands for it. `rules` go into the plan as literals, some hundred at most. Null URLs and
    those without `://` have an empty host and path and make one template; repeated rows count each;
    a table of any order gives the same verdicts, an empty one an empty one. A column named `out` is replaced.
    """
    own = fresh(df, "url_row")
    parsed = df.drop(out).withColumn(own, F.struct(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")))
    found = fresh(parsed, "url_rule")
    marked = parsed.withColumn(found, ruled(F.col(own)["host"], F.col(own)["path"], rules))
    known = F.col(found)["allow"]
    allow = known if label is None else F.coalesce(known, F.col(label).cast("boolean"))
    shape = F.regexp_replace(F.col(own)["path"], VARIABLE, "#")
    learnt = stored(templates(marked.select(F.col(own)["host"].alias("host"), shape.alias("shape"), allow.alias("allow")), settings))
    total = learnt.agg(F.sum("n")).first()[0] or 0

    # names of the lookup's columns that no column of df has
    host, at, salt, heavy, light = (fresh(marked, x) for x in ("t_host", "t_shape", "t_salt", "t_heavy", "t_light"))
    facts = F.struct("template", "labelled", "bad", "rejected")
    lookup = learnt.select(F.col("host").alias(host), F.col("shape").alias(at), facts.alias(heavy), (F.col("n") * HEAVY > total).alias(light))
    most = F.broadcast(lookup.filter(F.col(light)).drop(light))  # at most HEAVY rows
    rest = lookup.filter(~F.col(light)).select(host, at, F.lit(0).alias(salt), F.col(heavy).alias(light))
    rows = marked.withColumns({host: F.col(own)["host"], at: shape}).join(most, [host, at], "left")
    # rows that have their answer find none in the other join, and their salt deals them out
    spread = F.when(F.col(heavy).isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(url, F.rand(7)), F.lit(1 << 20))).cast("int")
    rows = rows.withColumn(salt, spread).join(rest, [host, at, salt], "left")
    fact = F.coalesce(heavy, light)
    verdict = F.when(F.coalesce(known, ~fact["rejected"]), "allow").otherwise("block")
    result = F.struct(
        F.col(own)["host"].alias("host"), F.col(own)["path"].alias("path"), F.col(found)["name"].alias("rule"),
        fact["template"].alias("template"), fact["labelled"].alias("labelled"), fact["bad"].alias("bad"), verdict.alias("verdict"))
    return rows.withColumn(out, result).select(*[c for c in df.columns if c != out], out)
