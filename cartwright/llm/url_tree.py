"""URL filter: editorial rules, and a tree of path templates per host for what no rule fits.

The tree is built level by level over all hosts at once. At each node a segment becomes a template part: numbers, ids and
the like by their form; any segment, as ``*``, where a node has many different ones that each come up rarely; and
sibling branches whose labelled rates do not differ by more than chance merge into one (``{+}``, ``{-}`` or ``{~}``, above,
below or at their siblings' rate). Branches without a label join ``{~}`` where ``LEAST_ALIKE`` labelled siblings or more
are all alike, and are ``{?}`` together elsewhere.

Purities are smoothed down the tree. A node's rate is that of the labelled segments below it, merged or not, each of which
counts as one observation at most however many rows it has, and ``STRENGTH`` observations at the rate of the node above; above a host
lies ``PRIOR``. A template's purity is the share of bad labels among its own and ``STRENGTH`` labels at the rate of the node
it hangs from, so one without labels has what its siblings say. A template is rejected where its purity reaches ``REJECT``.

Every level works on counts per host, template and segment, pre-aggregated from counts per distinct path, and is
written to the shared folder. No host's paths are ever gathered; joins on a host's templates spread hot keys.

Defined cases: a null url, or one without ``://``, has empty host and path and is judged by its template like others;
repeated urls count each time; null ids are kept; paths deeper than ``depth`` share their remaining segments as
``{rest}``; a very long url is one value; columns other than the url and the id are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.base import staged
from cartwright.operators.joins import lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEPTH = 8
#: A node with more branches than this, of fewer rows than that on average, has a variable segment.
MOST_BRANCHES, LEAST_MEAN = 24, 8
#: Labels a branch and its siblings need to be compared, and the standard errors by which rates differ beyond chance.
LEAST_LABELS, CHANCE = 5, 2.0
#: Labelled branches, none of which differs from the others, that a branch without labels joins.
LEAST_ALIKE = 5
#: The rate above all hosts, the observations that a rate above counts as, and the purity that rejects.
PRIOR, STRENGTH, REJECT = 0.05, 2.0, 0.8


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains, and paths that start with the pattern's; the longest that fits wins."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


#: The rules of the production query.
RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end."""
    known = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(known, "://") > 0, F.regexp_replace(known, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def decided(urls: DataFrame, rules: tuple[Rule, ...], url: str = "url") -> DataFrame:
    """``urls`` with host, path, and the rule that decides with its verdict (both null where none fits)."""
    host, path = host_and_path(F.col(f"`{url}`"))
    split = urls.drop("host", "path").withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: len(r.pattern)):
        rule = F.when(one.fits(), F.lit(one.pattern)).otherwise(rule)
        verdict = F.when(one.fits(), F.lit(one.verdict)).otherwise(verdict)
    return split.withColumns({"rule": rule, "ruled": verdict})


def _shape(segment: Column) -> Column:
    """The form of a segment where that makes it variable, else the segment; ``=`` marks literals that look like a part."""
    extension = F.regexp_extract(segment, r"(\.[A-Za-z0-9]{1,5})?$", 0)
    return (F.when(segment.rlike(r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$"), F.concat(F.lit("{n}"), F.when(segment.contains("."), extension).otherwise("")))
            .when(segment.rlike(r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), F.lit("{date}"))
            .when(segment.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), F.lit("{id}"))
            .when(segment.rlike(r"^[*{=]"), F.concat(F.lit("="), segment))
            .otherwise(segment))


def _against_rest(branches: DataFrame, group: list[str]) -> DataFrame:
    """``branches`` with ``differs``: by how many standard errors a branch's labelled rate is above (or, negative,
    below) that of the others in its group; null where it or they have too few labels."""
    sums = branches.groupBy(*group).agg(F.sum("bad").alias("all_bad"), F.sum("good").alias("all_good"))
    labels = F.col("bad") + F.col("good")
    all_labels = F.col("all_bad") + F.col("all_good")
    others, pooled = all_labels - labels, F.col("all_bad") / all_labels
    above = F.col("bad") / labels - (F.col("all_bad") - F.col("bad")) / others
    spread = F.sqrt(pooled * (1 - pooled) * (1 / labels + 1 / others))
    differs = F.when((labels >= LEAST_LABELS) & (others >= LEAST_LABELS), F.when(spread > 0, above / spread).otherwise(F.lit(0.0)))
    return branches.join(sums, group).withColumn("differs", differs).drop("all_bad", "all_good")


def _parts(branches: DataFrame) -> DataFrame:
    """``host, template, segment, part``: what each branch of each node is called.

    Branches first fall on the side of their siblings' rate that the test says; on one side, those that do not differ
    from the rest of it merge.
    """
    node = ["host", "template"]
    nodes = branches.groupBy(*node).agg(F.count(F.lit(1)).alias("branches"), F.sum("n").alias("all_n"))
    side = F.when(F.col("differs") > CHANCE, F.lit("{+}")).when(F.col("differs") < -CHANCE, F.lit("{-}")).when(
        F.col("differs").isNotNull(), F.lit("{~}")).otherwise(F.lit("few"))
    sided = _against_rest(_against_rest(branches, node).withColumn("side", side).drop("differs"), [*node, "side"])
    alike = sided.groupBy(*node).agg(F.count_if(F.col("side") == "{~}").alias("alike"), F.count_if(F.col("side").isin("{+}", "{-}")).alias("apart"))
    one_kind = (F.col("alike") >= LEAST_ALIKE) & (F.col("apart") == 0)
    part = (F.when((F.col("branches") > MOST_BRANCHES) & (F.col("all_n") < LEAST_MEAN * F.col("branches")), F.lit("*"))
            .when(F.col("branches") == 1, F.col("segment"))
            .when(F.col("bad") + F.col("good") == 0, F.when(one_kind, F.lit("{~}")).otherwise(F.lit("{?}")))
            .when((F.col("side") != "few") & (F.abs("differs") <= CHANCE), F.col("side"))
            .otherwise(F.col("segment")))
    return sided.join(nodes, node).join(alike, node).select(*node, "segment", part.alias("part"))


def templates(labelled: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``host, path, template, bad, good, purity`` for every distinct host and path of ``labelled (host, path, bad)``,
    bad being true, false or, unlabelled, null."""
    counts = [F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("bad"), 1)).alias("bad"), F.count(F.when(~F.col("bad"), 1)).alias("good")]
    state = staged(labelled.groupBy("host", "path").agg(*counts).withColumn("template", F.lit("")), "paths")
    segments = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split(F.substr(F.col("path"), F.lit(2)), "/", -1))
    for level in range(depth):
        longer = F.size(segments) > level
        if state.where(longer).isEmpty():
            break
        segment = _shape(F.get(segments, F.lit(level)))
        if level == depth - 1:
            segment = F.when(F.size(segments) > depth, F.lit("{rest}")).otherwise(segment)
        live = state.where(longer).withColumn("segment", segment)
        branches = live.groupBy("host", "template", "segment").agg(*[F.sum(c).alias(c) for c in ("n", "bad", "good")])
        stepped = lookup_join(live, _parts(branches), ["host", "template", "segment"], "inner", live.select("host", "template", "segment"),
                              ["host", "path"]).withColumn("template", F.concat("template", F.lit("/"), "part"))
        state = staged(stepped.select(*state.columns).unionByName(state.where(~longer)), "paths")
    return lookup_join(state.select("host", "path", "template"), purities(state), ["host", "template"], "inner",
                       state.select("host", "template"), ["path"])


def purities(paths: DataFrame) -> DataFrame:
    """``host, template, bad, good, purity`` from ``paths (host, path, template, bad, good)``, smoothed down the tree."""
    leaves = paths.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    parts = F.split("template", "/", -1)
    depth = F.size(parts) - 1  # a template is empty or starts with a slash
    prefix = lambda level: F.array_join(F.slice(parts, 1, level + 1), "/")
    # At every node on its way, and at its own, a path speaks for the segment that it goes on with there.
    heads = F.split("path", "/", -1)
    steps = paths.where(F.col("bad") + F.col("good") > 0).select("host", "bad", "good", F.explode(F.transform(
        F.sequence(F.lit(0), depth), lambda level: F.struct(
            prefix(level).alias("node"), F.when(level < depth, F.get(heads, level + 1)).alias("segment")))).alias("at"))
    branches = steps.select("host", "at.*", "bad", "good").groupBy("host", "node", "segment").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    labels = F.col("bad") + F.col("good")
    heard = labels / (labels + STRENGTH)
    nodes = branches.groupBy("host", "node").agg(
        F.sum(heard).alias("heard"), F.sum(heard * F.col("bad") / labels).alias("heard_bad"))
    above = leaves.select("host", "template", F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(depth - 1, F.lit(0))), prefix)).alias("level", "node"))
    rates = lookup_join(above, nodes, ["host", "node"], "left", above.select("host", "node"), ["template"]).groupBy("host", "template").agg(
        F.array_sort(F.collect_list(F.struct("level", F.coalesce("heard", F.lit(0.0)).alias("heard"), F.coalesce("heard_bad", F.lit(0.0)).alias("heard_bad")))).alias("path_rates"))
    rate = F.aggregate("path_rates", F.lit(PRIOR), lambda above, at: (at["heard_bad"] + STRENGTH * above) / (at["heard"] + STRENGTH))
    return leaves.join(rates, ["host", "template"]).withColumn(
        "purity", (F.col("bad") + STRENGTH * rate) / (F.col("bad") + F.col("good") + STRENGTH)).drop("path_rates")


def judged(urls: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", id_: str = "page_id", depth: int = DEPTH) -> DataFrame:
    """Per url: the id, host, path, rule, verdict, template and purity. The rules' own verdicts are the tree's labels."""
    rows = decided(urls.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{url}`").alias("url")), rules)
    tree = staged(templates(rows.select("host", "path", (F.col("ruled") == "block").alias("bad")), depth), "templates")
    method = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    met = lookup_join(rows, tree.select("host", "path", "template", "purity"), ["host", "path"], "inner", rows.select("host", "path"), ["id", "url"])
    return met.select(F.col("id").alias(id_), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity")
