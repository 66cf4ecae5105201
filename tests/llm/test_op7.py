import hashlib
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from reviewops.llm import op7_pii as op7

SPEC = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(x) * 2, 10)) if k % 2 else int(x) for k, x in enumerate(d[::-1])) % 10 == 0


def spec(text):
    out = []
    for k, (kind, pattern) in enumerate(SPEC.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def brute_added(rows, support=3, confidence=0.5, rounds=60):
    """Context spans of each row, with dictionaries."""
    edges, said = {}, []
    for text in rows:
        text = text or ""
        own = spec(text)
        both = [(s, e, True) for s, _, e in own]
        both += [(s, e, False) for s, e in op7.tokens(text) if not any(a < e and s < b for a, _, b in own)]
        for s, e, seed in both:
            for p in op7.patterns(text, s, e):
                key = p, text[s:e].lower()
                edges[key] = edges.get(key, False) or seed
        said.append(both)
    seeds = {i for (_, i), seed in edges.items() if seed}
    score, trusted = dict.fromkeys(seeds, 1.0), {}
    for _ in range(rounds):
        own = defaultdict(list)
        for (p, i), seed in edges.items():
            own[p].append(score.get(i, 0.0))
        trusted = {p: sum(v) / (len(v) + 1) for p, v in own.items() if sum(v) >= support - 1e-6}
        trusted = {p: x for p, x in trusted.items() if x >= confidence - 1e-6}
        miss = defaultdict(float)
        for (p, i), seed in edges.items():
            if not seed and p in trusted:
                miss[i] += math.log(1 - min(trusted[p], 0.999))
        score = {i: 1 - math.exp(x) for i, x in miss.items()} | dict.fromkeys(seeds, 1.0)
    return [sorted((s, e) for s, e, seed in both if not seed and set(op7.patterns(t or "", s, e)) & set(trusted))
            for t, both in zip(rows, said, strict=True)]


def test_base_spans_on_generated_texts():
    r = random.Random(9)
    bits = ["a", "b.c", "@", "@x", ".de", ".", "1", "255", "256", "0001", "4111111111111111", "4111 1111-1111 1111", "+", "+1 (555) 010-1234",
            " ", "-", "(", ")", "é", "\n", "12.34.56.78", "3.4", "%", "_", "+4930", "99", "٣"]
    for _ in range(6000):
        text = "".join(r.choice(bits) for _ in range(r.randrange(12)))
        assert op7.base_spans(text) == spec(text), text


def test_long_runs_end_in_time():
    for text in ("7" * 300_000, "a" * 300_000 + "@", "+1" + "(" * 300_000, "1." * 150_000, "x1" * 200_000, "a@" * 150_000):
        op7.base_spans(text)
        list(op7.tokens(text))


def corpus(seed):
    r = random.Random(seed)
    rows = []
    for i in range(60):
        words = [f"w{chr(97 + r.randrange(26))}" for _ in range(10)]
        words[3:3] = ["reach", "me:", r.choice([f"user{i}@mail.example.com", f"+1 (555) 555-{1000 + i}", f"10.0.0.{i}", f"badge-{i:05d}"])]
        words[9:9] = ["order", "number", f"A{i:06d}"]
        rows.append(" ".join(words))
    return rows


def test_discovers_unseen_identifiers_and_nothing_else(make_docs):
    texts = corpus(1)
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (None, "reach me: zz-12345"), (5, texts[5]), (5, texts[5]), (102, "x " * 500_000 + texts[0])]
    docs = make_docs(rows).withColumn("row", F.lit(1)).withColumn("base", F.lit(2)).withColumn("seed", F.lit(3))
    out = op7.find_personal_data(docs).collect()
    have = sorted((str(r.doc_id), [(s.start, op7.KINDS.index(s.kind), s.end) for s in r.base], [(s.start, s.end) for s in r.added]) for r in out)
    added = brute_added([t for _, t in rows])
    assert have == sorted((str(d), spec(t), a) for (d, t), a in zip(rows, added, strict=True))
    found = {t[s:e] for (_, t), a in zip(rows, added, strict=True) for s, e in a}
    assert "zz-12345" in found and any(x.startswith("badge") for x in found) and not any(x.startswith("A0") for x in found)


def test_empty(make_docs):
    assert op7.find_personal_data(make_docs([])).collect() == []


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    added = dict(zip([d for d, _ in docs], brute_added([t for _, t in docs]), strict=True))
    texts = dict(docs)
    rows = op7.op7_pii(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = spec(texts[r.doc_id])
        name = lambda spans: ",".join(f"{k}:{s}:{e}" for s, k, e in spans)
        named = [(s, op7.KINDS[k], e) for s, k, e in want]
        assert r.base_sha256 == hashlib.sha256(name(named).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, x, _ in want) for k in range(4)]
        order = [*op7.KINDS, "context"]
        assert r.spans == name(sorted(named + [(s, "context", e) for s, e in added[r.doc_id]], key=lambda x: (x[0], order.index(x[1]))))


def test_rounds_go_on_to_the_fixpoint(spark):
    rows = [(f"p{k}", f"mail{k}{j}@x.de", True) for k in range(6) for j in range(3 + 3 * (k == 0))]
    for k in range(5):
        # Instances that link a pattern to the next, which is trusted only with their scores.
        rows += [(f"p{k + j}", f"id{k}{i}", False) for i in range(3) for j in (0, 1)]
    edges = spark.createDataFrame(rows, "pattern string, instance string, seed boolean")
    few, all_ = (op7.trusted_patterns(edges, 3, 0.45, n).collect() for n in (1, None))
    again = op7.trusted_patterns(edges, 3, 0.45, 40).collect()
    assert sorted(r.pattern for r in all_) == sorted(r.pattern for r in again) and len(all_) > len(few)


def test_long_tokens_and_whole_context_words():
    long = "k1" * 100
    assert [long] == [long[s:e] for s, e in op7.tokens(long)]
    text = "x" + "y" * 300 + " " + "," * 10 + " key abc123 " + "." * 250 + " " + "z" * 400
    at = text.index("abc123")
    assert op7.patterns(text, at, at + 6) == [f"x{'y' * 300} key _", f"key _ {'z' * 400}"]


def test_discovered_instances_support_a_pattern_that_no_seed_stands_in(spark):
    rows = [("p", f"mail{k}@x.de", True) for k in range(20)]
    rows += [(p, x, False) for p in "pq" for x in ("id-x1", "id-y2", "id-z3", "id-u4")] + [("q", "id-w5", False)]
    rows += [("r", "id-w5", False), ("r", "order-1", False), ("r", "order-2", False), ("r", "order-3", False)]
    edges = spark.createDataFrame(rows, "pattern string, instance string, seed boolean")
    trusted = {r.pattern: r.confidence for r in op7.trusted_patterns(edges, 3, 0.5).collect()}
    assert sorted(trusted) == ["p", "q"] and trusted["q"] < trusted["p"]
    assert [r.pattern for r in op7.trusted_patterns(edges, 3, 0.5, 1).collect()] == ["p"]


def planted(seed):
    """Seeds and badges share one context, badges another, in which further badges stand that share none
    with any seed; order numbers stand in contexts of their own."""
    r = random.Random(seed)
    texts, unseen, other = [], set(), set()
    filler = lambda: " ".join(f"w{chr(97 + r.randrange(26))}" for _ in range(6))
    for i in range(200):
        badge, order = f"kx-{i:04d}", f"nr{i:05d}"
        parts = [filler()]
        if i < 170:
            parts.append("please reach me: " + (f"user{i}@mail.example.com" if i < 100 else badge) + " today")
        if i >= 100:
            parts.append("carried staff badge " + badge + " inside")
            unseen.add(badge)
        parts.append("order number " + order + " shipped")
        other.add(order)
        texts.append(" . ".join(parts))
    return texts, unseen, other


def test_two_hops_find_identifiers_that_never_stand_beside_a_seed(make_docs):
    texts, unseen, other = planted(4)
    out = {r.doc_id: r.added for r in op7.find_personal_data(make_docs(list(enumerate(texts)))).collect()}
    found = [t[s.start:s.end] for i, t in enumerate(texts) for s in out[i]]
    # Precision and recall are one: every badge, the thirty of the second hop too, and no order number.
    assert set(found) == unseen and len(found) == 170 and not set(found) & other


def test_tokens_of_any_length():
    text = "a 7 x1 @ @b --5-- word"
    assert [text[s:e] for s, e in op7.tokens(text)] == ["7", "x1", "@b", "5"]
