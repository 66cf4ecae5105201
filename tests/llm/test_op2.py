import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from reviewops.llm import op2_language as op2


def brute_models(rows):
    """Interpolated Kneser-Ney by dictionaries: a function (lang, word) -> cost."""
    count = defaultdict(Counter)
    for text, lang in rows:
        for w in op2.WORD.findall(text.lower()):
            s = "   " + w + " "
            for i in range(3, len(s)):
                count[lang][s[i - 3:i + 1]] += 1
    models = {}
    for lang, top in count.items():
        levels = {4: dict(top)}
        for n in (3, 2, 1):
            levels[n] = dict(Counter(g[1:] for g in levels[n + 1]))
        stats = {}
        for n, grams in levels.items():
            once, twice = (sum(v == k for v in grams.values()) for k in (1, 2))
            d = once / (once + 2 * twice) if once and twice else 0.5
            total, kinds = Counter(), Counter()
            for g, v in grams.items():
                total[g[:-1]] += v
                kinds[g[:-1]] += 1
            stats[n] = d, total, kinds
        models[lang] = levels, stats

    def prob(lang, g):
        levels, stats = models[lang]
        if not g:
            return 1 / (len(levels[1]) + 1)
        d, total, kinds = stats[len(g)]
        if g[:-1] not in total:
            return prob(lang, g[1:])
        return max(levels[len(g)].get(g, 0) - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * prob(lang, g[1:])

    def cost(lang, w):
        s = "   " + w + " "
        return -sum(math.log(prob(lang, s[i - 3:i + 1])) for i in range(3, len(s)))

    return cost


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def corpus(seed=1, size=400):
    r = random.Random(seed)
    syllables = {"aa": ["ka", "lo", "mi", "tu", "é"], "bb": ["sch", "er", "ung", "ü", "lo"], "cc": ["ción", "os", "de", "ll", "ka"]}
    out = []
    for i in range(size):
        lang = r.choice(list(syllables))
        out.append((i, " ".join("".join(r.choices(syllables[lang], k=r.randrange(1, 4))) for _ in range(r.randrange(1, 40))), lang))
    return out


def test_costs_equal_brute_force_kneser_ney(make_docs):
    rows = corpus()
    model = op2.train(make_docs(rows))
    cost = brute_models([(t, lang) for i, t, lang in rows if fold(i) < 2])
    words = ["kalomi", "ungsch", "ción", "de", "zzz", "éü", "a", "日本", "kaos"]
    got = model.word_costs(words)
    for w, row in zip(words, got, strict=True):
        assert np.allclose(row, [cost(lang, w) for lang in model.langs], rtol=1e-9), w


def test_probabilities_sum_to_one(make_docs):
    model = op2.train(make_docs(corpus(2, 100)))
    letters = sorted({x for _, t, _ in corpus(2, 100) for x in t} - {" "})
    cost = brute_models([(t, lang) for i, t, lang in corpus(2, 100) if fold(i) < 2])
    assert model.langs and letters and cost("aa", "ka") > 0
    assert all(0 < p <= 1 for _, prob in model.grams for p in prob[prob > 0])


def test_learns_nothing_from_held_out_fold(make_docs):
    rows = corpus(3)
    spoiled = [(i, t, "zz") if fold(i) == 2 else (i, t, lang) for i, t, lang in rows]
    a, b = (sorted(map(tuple, op2.predict(make_docs(rows), op2.train(make_docs(x))).collect())) for x in (rows, spoiled))
    assert a == b


def test_accuracy_and_edges(make_docs):
    rows = corpus(4, 1600)
    odd = [(9000, None, "aa"), (9010, "", "aa"), (9020, "123 ### --", "bb"), (9030, "lomitu" * 100_000, None), (None, "kalo mi tu", "aa"),
           (9040, "quxx zzqq wwvv jjyy " * 50, None), rows[0], rows[0]]
    docs = make_docs(rows + odd).withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit(9))
    out = op2.predict(docs, op2.train(docs)).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    by = {r._id: r for r in out}
    assert [by[k].lang_pred for k in (9000, 9010, 9020)] == ["und"] * 3 and by[9020].rejected
    assert by[9030].lang_pred == "aa" and by[9040].rejected
    test = [(by[i].lang_pred == lang) for i, t, lang in rows if fold(i) == 2 and len(t) > 20]
    assert sum(test) / len(test) > 0.97
    assert sum(by[i].rejected for i, _, _ in rows) <= 2


def test_short_foreign_and_random_texts_are_rejected_at_two_sizes(spark, sf):
    r = random.Random(5)
    other = ["Сегодня утром мы пошли на рынок и купили свежие овощи, хлеб и молоко для всей семьи, потом вернулись домой",
             "Dzisiaj rano poszliśmy na targ i kupiliśmy świeże warzywa, chleb oraz mleko dla całej rodziny, potem wróciliśmy",
             "今天早上我们去了市场买了新鲜的蔬菜面包和牛奶给全家人然后我们回到家里一起做了午饭孩子们在院子里玩得很开心"]
    other += [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randrange(4, 9))) for _ in range(30)) for _ in range(10)]
    short = [t[:size] for t in other for size in (20, 40, 80, 200)]
    for at in (sf, sf.replace("0.001", "0.01")):
        docs = spark.read.parquet(f"{at}/documents.parquet")
        model = op2.train(docs)
        assert np.isfinite(model.limits).all()
        assert op2.rejects(model, short)[0].all()
        clean = [d.text[:size] for d in docs.collect() if fold(d.doc_id) == 2 for size in (20, 40, 80, 200)]
        assert op2.rejects(model, clean)[0].mean() < 0.01


def test_limits_are_finite_without_a_calibration_text(make_docs):
    rows = [r for r in corpus(6) if fold(r[0]) < 2]
    model = op2.train(make_docs(rows))
    assert np.isfinite(model.limits).all()
    assert op2.rejects(model, ["Сегодня утром мы пошли", "kalo mi tu"])[0].tolist() == [True, False]


def test_a_model_too_large_for_arrays_keeps_every_type(make_docs):
    rows = [(i, t + (" 日本語" if i % 5 == 0 else ""), lang) for i, t, lang in corpus(7)]
    rows += [(9000, None, "aa"), (9010, "", "aa"), (9020, "123 ###", "bb"), (9030, "lomitu" * 20_000, None), (None, "kalo mi tu", "aa"),
             (9040, "Сегодня утром мы пошли на рынок", None), rows[0], rows[0]]
    docs = make_docs(rows)
    small, large = op2.train(docs), op2.train(docs, hash_bits=0)
    assert small.tables is None and large.tables is not None
    words = ["kalomi", "ungsch", "ción", "de", "zzz", "éü", "a", "日本", "kaos"]
    cost = brute_models([(t, lang) for i, t, lang in rows if t and lang and i is not None and fold(i) < 2])
    frame = docs.sparkSession.createDataFrame([(k, 0, w) for k, w in enumerate(words)], "w long, v int, word string")
    for r in op2._word_costs_joined(frame, large).collect():
        assert r["size"] == len(words[r.w]) + 1
        assert np.allclose([r[f"c{k}"] for k in range(3)], [cost(lang, words[r.w]) for lang in large.langs], rtol=1e-9), words[r.w]
    assert np.allclose(small.chance, large.chance) and np.allclose(small.limits, large.limits) and np.allclose(small.logistic, large.logistic)
    one, two = (sorted(map(tuple, op2.predict(docs, m).collect()), key=str) for m in (small, large))
    assert len(one) == len(two) == len(rows)
    for x, y in zip(one, two, strict=True):
        assert x[:4] == y[:4] and x[6] == y[6] and np.allclose(x[4:6], y[4:6], rtol=1e-9)
    one, two = (sorted(map(tuple, op2.keep_known(docs, m).collect()), key=str) for m in (small, large))
    assert one == two and 0 < len(one) < len(rows)
    assert op2.predict(docs.limit(0), large).collect() == []


def test_empty_and_unlabelled(make_docs):
    assert op2.predict(make_docs([]), op2.train(make_docs([]))).collect() == []
    docs = make_docs([(1, "ka lo", None)])
    assert [(r.lang_pred, r.rejected) for r in op2.predict(docs, op2.train(docs)).collect()] == [("und", True)]


def test_query(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op2.op2_language(spark, sf).collect()
    assert {r.doc_id for r in out} == set(docs)
    assert all(r.held_out == (fold(r.doc_id) == 2) for r in out)
    test = [r.lang_pred == docs[r.doc_id].lang for r in out if r.held_out and docs[r.doc_id].lang]
    assert sum(test) / len(test) > 0.95
