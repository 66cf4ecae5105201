import random

import regex
from pyspark.sql import functions as F

from reviewops.llm import op4_benchmark as op4


def words(text):
    return [w for w in _tokens(text) if w.isalnum()]  # vowel signs beside letters are none


def _tokens(text):
    return regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|[^\W_\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}"
                         r"\p{Khmer}\p{Myanmar}]+", (text or "").lower())


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(docs, items):
    out, queries = [], [(i, size, shingles(x, size)) for i, x in set(items) if (size := min(5, len(words(x))))]
    for d, t in docs:
        have = {size: shingles(t, size) for size in {s for _, s, _ in queries}}
        for i, size, q in queries:
            if len(q & have[size]) >= 0.8 * len(q):
                out.append((d, i, len(q & have[size]), len(q)))
    return sorted(out, key=str)


def got(docs, items, make_docs, spark):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = op4.contaminated(make_docs(docs), bench)
    return sorted(((r._id, r.item, r.n_shared, r.n_shingles) for r in found.collect()), key=str)


def sample(seed):
    r = random.Random(seed)
    say = lambda n: [f"w{r.randrange(60)}é" for _ in range(n)]
    items = [(i, " ".join(say(r.randrange(3, 60)))) for i in range(25)]
    docs = []
    for d in range(120):
        w = say(r.randrange(0, 300))
        for _ in range(r.randrange(3)):
            part = r.choice(items)[1].upper().split(" ")
            for _ in range(r.randrange(3)):
                part[r.randrange(len(part))] = "X"
            at = r.randrange(len(w) + 1)
            w[at:at] = [x + r.choice(["", ",", "!!"]) for x in part]
        docs.append((d, " ".join(w)))
    return docs, items


def test_against_brute_force(make_docs, spark, monkeypatch):
    docs, items = sample(1)
    docs += [(200, None), (201, ""), docs[0], (None, items[7][1]), (202, items[3][1] + " " + "tail " * 400_000)]
    items += [(90, None), (91, "too short here"), items[0], (None, "one two three four five six seven")]
    docs += [(203, "ONE two_three four; five six seven!")]
    want = brute(docs, items)
    assert len(want) > 30
    assert got(docs, items, make_docs, spark) == want
    monkeypatch.setattr(op4, "BLOCK_SHINGLES", 400)
    assert got(docs, items, make_docs, spark) == want


def test_empty_tables_and_odd_columns(make_docs, spark):
    docs, items = sample(2)
    assert got([], items, make_docs, spark) == [] and got(docs, [], make_docs, spark) == []
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("parts", F.lit(1)).withColumn("q", F.lit(0))
    found = op4.contaminated(make_docs(docs).withColumn("item", F.lit(1)).withColumn("item_id", F.lit(2)), bench)
    assert sorted(((r._id, r.item, r.n_shared, r.n_shingles) for r in found.collect()), key=str) == brute(docs, items)


def test_sketch_length_loses_no_item():
    parts = [[f"{i}-{k}" for k in range(n)] for i, n in enumerate([1, 2, 3, 4, 5, 9, 10, 31, 63])]
    s = op4.Sketches(parts, 0.8)
    for i, p in enumerate(parts):
        least = next(sum(item == i) for _, _, item in s.classes if (item == i).any())
        assert least >= len(p) - s.need[i] + 1


def test_short_items_and_unspaced_scripts(make_docs, spark, monkeypatch):
    chinese = "机器学习模型在训练时看到了测试集中的全部题目和答案"
    items = [(1, "capital of France is"), (2, chinese), (3, "東京"), (4, "one"), (5, "!!"), (6, "ภาษาไทยไม่มีช่องว่างระหว่างคำ")]
    docs = [(1, "The Capital, of france is Paris"), (2, "前言" + chinese + "后记abc"), (3, "capital of old France is"), (4, "昨日東京へ行った one-two"),
            (5, chinese[:12] + "别" + chinese[13:]), (6, "เขียน ภาษาไทยไม่มีช่องว่างระหว่างคำ เสมอ"), (7, None), (8, "東 京 ONE")]
    want = brute(docs, items)
    assert {(d, i) for d, i, *_ in want} == {(1, 1), (2, 2), (4, 3), (4, 4), (6, 6), (8, 3), (8, 4)}
    assert got(docs, items, make_docs, spark) == want
    clean = op4.clean_documents(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in clean.collect()) == [3, 5, 7]
    monkeypatch.setattr(op4, "BLOCK_SHINGLES", 3)  # every longer item is a block of its own
    assert got(docs, items, make_docs, spark) == want
    blocks = op4.clean_documents(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(str, blocks.collect())) == sorted(map(str, clean.collect())) and blocks.columns == clean.columns
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(con.execute(op4.OP4_SQL).fetchall(), key=str) == want


def test_query_and_sql_twin(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = sorted(con.execute(op4.OP4_SQL).fetchall())
    assert want and sorted(tuple(r) for r in op4.op4_decontamination(spark, sf).collect()) == want
