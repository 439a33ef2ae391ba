"""The quality ledger and the url filter."""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import cache

import duckdb
import pytest
from pyspark.sql import functions as F

from cartwright.llm import quality, url_tree
from cartwright.llm.registry import CHECKS
from tests.compare import difference

DDL = "doc_id bigint, text string, words int, body string, failures int"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], DDL)


TEXTS = [None, "", "  \n \t", "a b c d e f g h i j", "a b c d e a b c d e", "w w w w w w w w w w w w", "one two three four",
         "l1 x\nl1 x\n\n \nl1 x\nother", "## $$ %% && | < > * a b c", "a b c d e f\x1cg h i j k l m",
         "é ü 日本 text " * 3, "x" * 5000, "1 2 3 4 5 6 7 8 9 10 11 12", "word\x0bword\x0cword\rword " * 9, "same line\n" * 40]


def test_ledger_like_sql(spark, small_parts):
    rng = random.Random(0)
    texts = TEXTS + [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60))) for _ in range(80)] + [
        "\n".join(" ".join(rng.choice(["aa", "bb"]) for _ in range(3)) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    texts += [" ".join(f"w{rng.randrange(3000)}" for _ in range(20_000))]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    shown = quality.ledger(docs(spark, texts)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.judge(quality.BASE_POLICY)).alias("base_failed"), quality.judge(quality.PROSE_POLICY).alias("kept"), "failures")
    assert difference(shown, con, CHECKS["op8_quality_rules"]) is None


def test_no_python_and_no_shuffle_in_the_plan(spark, small_parts):
    frame = quality.ledger(docs(spark, TEXTS))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_policies_and_ablations_from_bits(spark, small_parts):
    entries = quality.ledger(docs(spark, TEXTS))
    bits = [r["failures"] for r in entries.select("failures").collect()]
    policy = quality.Policy("three", 2, ("too_few_words", "too_many_symbols", "repeats_lines"))
    rows = {r["rule"]: r for r in quality.ablations(entries, policy).collect()}
    for rule in policy.rules:
        b = quality.bit(rule)
        alone = sum(x & policy.mask == b for x in bits)
        kept = sum(x & policy.mask == 0 for x in bits)
        assert (rows[rule]["failed"], rows[rule]["alone"], rows[rule]["kept"]) == (sum(bool(x & b) for x in bits), alone, kept + alone)
    assert entries.where(quality.judge(policy)).count() == sum(x & policy.mask == 0 for x in bits)
    assert quality.ledger(docs(spark, [])).count() == 0


URLS = ["http://a.net/x/1?q#f", "HTTP://WWW.Example.NET/en/7", "https://example.com/de/", "https://example.com/de", "ftp://x.org/fr/a",
        "http://dotnet/x", "http://b.net", "http://b.net?x=/", "http://É.ORG/fr/1", "no scheme/net/", None, "", "://net/", "a://b://c.net/d",
        "http://u@h.net:80/", "http://line\nbreak.net/a\nb?c", "http://example.net/EN/1"]


def plainly(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r.pattern for r in url_tree.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=len, default=None)


def naive_shape(segment):
    if m := re.fullmatch(r"[0-9]+(\.[A-Za-z0-9]{1,5})?", segment):
        return "{n}" + (m[1] or "")
    if re.fullmatch(r"[0-9]{4}-[0-9]{2}(-[0-9]{2})?", segment):
        return "{date}"
    if re.search("[0-9]", segment) and re.fullmatch(r"[0-9A-Fa-f-]{8,}", segment):
        return "{id}"
    return "=" + segment if segment[:1] in ("*", "{", "=") and segment else segment


def naive_against(branches):
    """How far each branch (bad, good) is from the others together, in standard errors; None where that cannot be told."""
    out = {}
    for name, (bad, good) in branches.items():
        others = [v for k, v in branches.items() if k != name]
        ob, og = sum(b for b, _ in others), sum(g for _, g in others)
        if bad + good < url_tree.LEAST_LABELS or ob + og < url_tree.LEAST_LABELS:
            out[name] = None
            continue
        pooled = (bad + ob) / (bad + good + ob + og)
        spread = (pooled * (1 - pooled) * (1 / (bad + good) + 1 / (ob + og))) ** 0.5
        out[name] = (bad / (bad + good) - ob / (ob + og)) / spread if spread else 0.0
    return out


def naive_parts(rows):
    """Branch name to template part at one node, from (segment, bad) of its rows."""
    counts = {}
    for segment, bad in rows:
        c = counts.setdefault(segment, [0, 0, 0])
        c[0] += 1
        if bad is not None:
            c[1 if bad else 2] += 1
    if len(counts) > url_tree.MOST_BRANCHES and len(rows) < url_tree.LEAST_MEAN * len(counts):
        return dict.fromkeys(counts, "*")
    if len(counts) == 1:
        return {k: k for k in counts}
    labels = {k: (c[1], c[2]) for k, c in counts.items()}
    side = {k: "few" if z is None else "{+}" if z > url_tree.CHANCE else "{-}" if z < -url_tree.CHANCE else "{~}"
            for k, z in naive_against(labels).items()}
    out, sides = {}, list(side.values())
    alike = sides.count("{~}") >= url_tree.LEAST_ALIKE and not {"{+}", "{-}"} & set(sides)
    for k in counts:
        z = naive_against({j: labels[j] for j in counts if side[j] == side[k]})[k]
        out[k] = ("{~}" if alike else "{?}") if not sum(labels[k]) else side[k] if side[k] != "few" and z is not None and abs(z) <= url_tree.CHANCE else k
    return out


def naive_tree(rows, depth=url_tree.DEPTH):
    """(host, path) to template and purity, from (host, path, verdict or None), one node after the other."""
    state = [[h, [] if p == "" else p[1:].split("/"), "", None if v is None else v == "block", p] for h, p, v in rows]
    for level in range(depth):
        nodes = {}
        for r in state:
            if len(r[1]) > level:
                segment = "{rest}" if level == depth - 1 and len(r[1]) > depth else naive_shape(r[1][level])
                nodes.setdefault((r[0], r[2]), []).append((r, segment))
        for members in nodes.values():
            parts = naive_parts([(segment, r[3]) for r, segment in members])
            for r, segment in members:
                r[2] += "/" + parts[segment]
    leaves = {}
    for h, _, t, bad, _ in state:
        c = leaves.setdefault((h, t), [0, 0])
        if bad is not None:
            c[0 if bad else 1] += 1

    def rate(host, node):
        """A node's rate: the labelled segments below it, one observation each at most, and the rate above."""
        above = url_tree.PRIOR if node == "" else rate(host, node.rpartition("/")[0])
        segments, level = {}, node.count("/")
        for h, path, t, bad, _ in state:
            if h == host and bad is not None and (t == node or t.startswith(node + "/")):
                c = segments.setdefault(None if t == node else path[level], [0, 0])
                c[0 if bad else 1] += 1
        heard = {k: (b + g) / (b + g + url_tree.STRENGTH) for k, (b, g) in segments.items()}
        bad = sum(w * segments[k][0] / sum(segments[k]) for k, w in heard.items())
        return (bad + url_tree.STRENGTH * above) / (sum(heard.values()) + url_tree.STRENGTH)

    rate = cache(rate)
    out = {}
    for h, _, t, _, path in state:
        bad, good = leaves[h, t]
        out[h, path] = t, (bad + url_tree.STRENGTH * rate(h, t.rpartition("/")[0])) / (bad + good + url_tree.STRENGTH)
    return out


def test_templates_and_purities_like_a_naive_tree(spark, small_parts):
    rng = random.Random(8)
    rows = []
    for host in ("a", "b", "c"):
        for _ in range(400):
            path = "/" + "/".join(rng.choice(["ads", "news", "x1", str(rng.randrange(50)), f"p{rng.randrange(60)}", "*s", "2024-05", "0123abcdef"])
                                  for _ in range(rng.randrange(0, 5)))
            bad = None if rng.random() < 0.5 else ("ads" in path) != (rng.random() < 0.1)
            rows.append((host, path if rng.random() < 0.95 else "", bad))
    got = url_tree.templates(spark.createDataFrame(rows, "host string, path string, bad boolean"), 4).collect()
    wanted = naive_tree([(h, p, None if b is None else "block" if b else "allow") for h, p, b in rows], 4)
    assert {(r["host"], r["path"]): (r["template"], round(r["purity"], 9)) for r in got} == {
        k: (t, round(p, 9)) for k, (t, p) in wanted.items()}
    assert len({round(p, 6) for _, p in wanted.values()}) > 20


def test_bad_siblings_reject_an_unruled_path(spark, small_parts):
    """Ten bad sections say enough about an eleventh; one does not, nor do ten that disagree."""
    urls = [(f"http://{host}/s{k}/{i}",) for host in ("all", "some") for k in range(10) for i in range(12)]
    urls += [("http://one/s0/1",)] * 50 + [(f"http://{host}/new/page",) for host in ("all", "some", "one", "none")]
    rules = (url_tree.Rule("block", "all/s"), url_tree.Rule("block", "one/s"),
             *[url_tree.Rule("block" if k % 2 else "allow", f"some/s{k}") for k in range(10)])
    frame = spark.createDataFrame([(i, *u) for i, u in enumerate(urls)], "page_id bigint, url string")
    got = {r["host"]: r for r in url_tree.judged(frame, rules).where("path = '/new/page'").collect()}
    assert {h: (r["rule"], r["verdict"]) for h, r in got.items()} == {
        "all": (None, "block"), "some": (None, "allow"), "one": (None, "allow"), "none": (None, "allow")}
    assert got["all"]["purity"] > got["some"]["purity"] > got["none"]["purity"] < got["one"]["purity"] < got["all"]["purity"]
    assert got["none"]["purity"] == pytest.approx(url_tree.PRIOR)


def test_hosts_paths_and_rules(spark, small_parts):
    rows = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(URLS)], "page_id bigint, url string, host string, n int")
    got = {r["page_id"]: r for r in url_tree.judged(rows).collect()}
    verdicts = {r.pattern: r.verdict for r in url_tree.RULES}
    for i, url in enumerate(URLS):
        host, path, rule = plainly(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        if rule:
            assert got[i]["verdict"] == verdicts[rule]
    naive = naive_tree([(plainly(u)[0], plainly(u)[1], verdicts.get(plainly(u)[2])) for u in URLS])
    for i, url in enumerate(URLS):
        host, path, rule = plainly(url)
        assert (got[i]["template"], got[i]["purity"]) == (naive[host, path][0], pytest.approx(naive[host, path][1]))
        assert got[i]["verdict"] == (verdicts[rule] if rule else "block" if naive[host, path][1] >= url_tree.REJECT else "allow")
    assert url_tree.judged(rows.limit(0)).count() == 0


def test_templates_generalise_merge_and_judge(spark, small_parts):
    rows = [("h", f"/ads/{i}", True) for i in range(20)] + [("h", f"/ads/{100 + i}.html", None) for i in range(5)]
    rows += [("h", f"/news/{i}", False) for i in range(20)] + [("h", f"/blog/{i}", False) for i in range(20)]
    rows += [("h", "/about", None), ("h", "/help", None), ("h", "", None), ("h", "/", None), ("h", "/*x", None)]
    rows += [("u", f"/u/name{chr(97 + i // 26)}{chr(97 + i % 26)}/home", False if i % 2 else None) for i in range(60)]
    rows += [("d", "/" + "/".join("abcdefghijkl"), None)]
    frame = spark.createDataFrame(rows, "host string, path string, bad boolean")
    got = {(r["host"], r["path"]): r for r in url_tree.templates(frame).collect()}
    assert got["h", "/ads/3"]["template"] == "/ads/{n}" and got["h", "/ads/3"]["purity"] >= url_tree.REJECT
    # Twenty bad siblings and no other speak for a branch without labels; where they disagree its purity stays low.
    assert got["h", "/ads/101.html"]["template"] == "/ads/{?}" and got["h", "/ads/101.html"]["purity"] >= url_tree.REJECT
    assert url_tree.PRIOR < got["h", "/about"]["purity"] < 0.5 and got["d", rows[-1][1]]["purity"] == pytest.approx(url_tree.PRIOR)
    assert got["h", "/news/1"]["template"] == got["h", "/blog/1"]["template"] == "/{-}/{n}" and got["h", "/news/1"]["good"] == 40
    assert got["h", "/about"]["template"] == got["h", "/help"]["template"] == "/{?}" and got["h", ""]["template"] == ""
    assert {got["u", p]["template"] for h, p, _ in rows if h == "u"} == {"/u/*/home"}
    assert got["d", rows[-1][1]]["template"] == "/a/b/c/d/e/f/g/{rest}"
    assert Counter(r["host"] for r in got.values()) == Counter(h for h, _ in {(h, p) for h, p, _ in rows})


def test_a_hot_host_is_judged_like_others(spark, small_parts):
    rows = spark.range(3000).select(F.lit("hot").alias("host"), F.concat(F.lit("/p/"), F.col("id").cast("string")).alias("path"),
                                    (F.col("id") < 2700).alias("bad"))
    got = url_tree.templates(rows)
    assert {(r["template"], r["bad"], r["good"]) for r in got.select("template", "bad", "good").distinct().collect()} == {("/p/{n}", 2700, 300)}
