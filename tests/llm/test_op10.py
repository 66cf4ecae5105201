import math
import random
import re
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from reviewops.llm import op10_urls as op10

ASCII_LOWER = {k: k + 32 for k in range(65, 91)}


def spec_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(ASCII_LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def spec_rule(host, path):
    fits = [(v, h + p) for v, h, p in op10.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[1])) if fits else (None, None)


def spec_words(html):
    text = re.sub(r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&#?\w+;", " ", html or "", flags=re.A)
    return Counter(re.findall(r"[^\W\d_]+", text.lower()))


def spec_split(name, known, total):
    """Best split by trying every one."""
    cost = lambda w: math.log(known[w] / total) if known.get(w) else -math.log(total) - len(w) * math.log(10)
    best = None
    for k in range(len(name)):
        for cut in combinations(range(1, len(name)), k):
            words = [name[a:b] for a, b in zip((0, *cut), (*cut, len(name)), strict=True)]
            p = sum(map(cost, words))
            if best is None or p > best[0] + 1e-12:
                best = p, words
    return best


def brute(rows):
    known = Counter()
    for _, _, html in rows:
        known.update(spec_words(html))
    total = max(sum(known.values()), 1)
    pages = []
    for page_id, url, _ in rows:
        host, path = spec_parts(url)
        words = [w for name in re.findall(r"[^\W\d_]+", host) for w in op10.split_name(name, known, total)]
        tokens = ["h:" + w for w in words] + ["p:" + re.sub("[0-9]", "0", w) for w in re.findall(r"[^\W\d_]+|[0-9]+", path.lower())]
        pages.append((page_id, host, path, *spec_rule(host, path), " ".join(words), tokens))
    bad, good, n_bad, n = Counter(), Counter(), 0, 0
    for *_, verdict, _rule, _words, tokens in pages:
        if verdict:
            n, n_bad = n + 1, n_bad + (verdict == "block")
            (bad if verdict == "block" else good).update(tokens)
    size = max(len(set(bad) | set(good)), 1)
    sb, sg = sum(bad.values()), sum(good.values())
    out = []
    for page_id, host, path, verdict, rule, words, tokens in pages:
        odds = math.log((n_bad + 1) / (n - n_bad + 1)) if n else 0.0
        odds += sum(math.log((bad[t] + 1) / (sb + size)) - math.log((good[t] + 1) / (sg + size)) for t in tokens if bad[t] + good[t])
        out.append((page_id, host, path, rule, verdict or ("block" if odds > 1e-9 else "allow"), words))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, " ".join(r.words or [])) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_split_is_the_best_of_all_splits():
    r = random.Random(4)
    known = {"the": 50, "re": 20, "there": 4, "in": 30, "a": 9, "ion": 7, "tion": 11}
    for _ in range(60):
        name = "".join(r.choice(["the", "re", "in", "a", "tion", "x", "q"]) for _ in range(r.randrange(1, 5)))[:11]
        words = op10.split_name(name, known, 131)
        cost = sum(math.log(known[w] / 131) if w in known else -math.log(131) - len(w) * math.log(10) for w in words)
        assert "".join(words) == name and abs(cost - spec_split(name, known, 131)[0]) < 1e-9


def test_parts_rules_and_verdicts_against_brute_force(spark):
    r = random.Random(6)
    rows = [(i, f"{r.choice(['http', 'HTTPS'])}://{r.choice(['', 'www.', 'm.'])}{r.choice(['cheappills', 'bestnews', 'X1ads-track'])}.Example."
             f"{r.choice(['com', 'org', 'net'])}{r.choice(['', '/', '/de/', '/fr/', '/es/', '/en/1', '/en/2'])}{r.choice(['', 'a?b=/c', '#x', '7.html'])}",
             r.choice(["<p>cheap pills, best news</p><script>var ads</script>", "<b>track</b> Best &amp; news", None])) for i in range(150)]
    rows += [(900, None, None), (901, "no scheme", "x"), (902, "://", ""), (903, "a://b://c/d", "b"), (904, "http://org/x?y", None),
             (905, "http://org", None), (906, "x://ORG/", None), (None, "http://notorg/fr/", "y"), (907, "ftp://É.com/fr/É", "é"), rows[0], rows[0],
             (908, "http://" + "longname" * 500 + ".com/de/" + "x/" * 50_000, "long name")]
    pages = table(spark, rows).withColumn("host", F.lit("q")).withColumn("rule", F.lit(1)).withColumn("words", F.lit(2))
    have, want = got(op10.judge_urls(pages)), brute(rows)
    assert have == want
    assert {v for *_, v, _ in want} == {"allow", "block"}


def test_empty_and_unlabelled(spark):
    assert op10.judge_urls(table(spark, [])).collect() == []
    rows = [(1, "http://a.net/x", "word"), (2, None, None)]
    assert got(op10.judge_urls(table(spark, rows))) == brute(rows)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in op10.op10_url_filter(spark, sf).collect()), key=str) == brute(rows)


LONG = "donaudampfschifffahrtsgesellschaft"


def test_names_and_words_of_any_length(spark):
    stem = LONG[:op10.STEM]
    rows = [(i, f"http://{h}.net/x", " ".join([LONG] * 50 + ["kasse", stem + "other", stem])) for i, h in enumerate(
        [LONG, LONG + "kasse", "kasse" + LONG, "q" * 300, stem, stem + "other", LONG + LONG])]
    have = got(op10.judge_urls(table(spark, rows)))
    assert have == brute(rows)
    words = {h.removesuffix(".net"): w.removesuffix(" net") for _, h, *_, w in have}
    assert words[LONG] == LONG and words[LONG + "kasse"] == f"{LONG} kasse" and words["kasse" + LONG] == f"kasse {LONG}"
    assert words["q" * 300] == "q" * 300 and words[stem + "other"] == stem + "other" and words[LONG + LONG] == f"{LONG} {LONG}"


def test_every_token_has_a_weight_of_its_own(spark):
    tokens = [(f"p:{k}", k % 2, 1) for k in range(300_000)] + [("p:none", 0, 0)]
    weights = op10.token_weights(spark.createDataFrame(tokens, "token string, bad long, n long"))
    by_sign = {r.up: r["count"] for r in weights.groupBy((F.col("weight") > 0).alias("up")).count().collect()}
    assert by_sign == {True: 150_000, False: 150_000}


def test_hot_host_and_path(spark):
    rows = [(i, "http://bigads.net/de/cheap" if i % 3 else f"http://n{chr(97 + i % 26)}s.com/{'de' if i % 2 else 'fr'}/{i}", "big ads") for i in range(600)]
    assert got(op10.judge_urls(table(spark, rows))) == brute(rows)
