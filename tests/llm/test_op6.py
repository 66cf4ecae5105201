import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from reviewops.llm import op6_lines
from reviewops.llm.op6_lines import DIVISOR, line_dedup, op6_line_dedup


def pair_counts(rows):
    return Counter(p for _, t in rows for x in [(t or "").split("\n")] for p in zip(x, x[1:], strict=False))


def chunks(text, count):
    lines = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    runs = [[0]]
    for i in range(1, len(lines)):
        runs[-1].append(i) if count[lines[i - 1], lines[i]] > 1 else runs.append([i])
    out = []
    for run in runs:
        zero = [i for i in run[1:] if (i % 2 if h[i - 1:i] == h[i + 1:i + 2] else (31 * h[i - 1] + h[i]) % DIVISOR == 0)]
        ends = [i for i in zero if i - 1 not in zero and i < run[-1] - 1] + [run[-1]]
        start = run[0]
        for e in ends:
            out.append(lines[start:e + 1])
            start = e + 1
    return out


def brute(rows):
    """Kept text of each row; of equal rows one is the first."""
    count, first = pair_counts(rows), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        for pos, part in enumerate(chunks(rows[i][1], count)):
            first.setdefault("\n".join(part), (i, pos))
    out = []
    for i, (d, t) in enumerate(rows):
        kept = [x for pos, p in enumerate(chunks(t, count)) if len(p) == 1 or first["\n".join(p)] == (i, pos) for x in p]
        n = len((t or "").split("\n"))
        out.append((d, n, n - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r._id, r.n_lines, r.n_removed, r.kept_text) for r in df.collect()), key=str)


def corpus(seed, size):
    r = random.Random(seed)
    lines = [f"line {i} é" for i in range(40)] + ["", " "]
    block = [r.choices(lines, k=r.randrange(2, 12)) for _ in range(6)]
    rows = []
    for i in range(size):
        x = r.choices(lines, k=r.randrange(4))
        for _ in range(r.randrange(3)):
            x = x + r.choice(block) + r.choices(lines, k=r.randrange(2))
        rows.append((i, "\n".join(x)))
    return rows


def test_against_brute_force(make_docs):
    for seed in (1, 2):
        rows = corpus(seed, 80)
        rows += [(500, None), (501, ""), (502, "\n"), (503, "\n"), rows[3], rows[3], (None, "a\nb\nc\nd\ne\nf\ng"), (600, "a\nb\nc\nd\ne\nf\ng")]
        have, want = got(line_dedup(make_docs(rows))), brute(rows)
        assert have == want
        assert sum(r[2] for r in want) > 20


def test_a_shift_moves_no_boundary_beyond_the_rim():
    lines = [f"s{i}" for i in range(200)]
    texts = ["\n".join(lines), "\n".join(["new", "lines", "here", *lines]), "\n".join(lines)]
    count = pair_counts([(0, t) for t in texts])
    whole, shifted = chunks(texts[0], count), chunks(texts[1], count)
    assert shifted[3:] == whole and min(map(len, whole)) == 2
    count["here", "s0"] = 2  # now the run starts three lines earlier
    assert chunks(texts[1], count)[-len(whole) + 2:] == whole[2:]


def test_short_shared_passages_go(make_docs):
    """A notice of three lines in fifty texts stays once; passages of two lines and more, too."""
    r = random.Random(7)
    rows = [(i, "\n".join([f"own {i}", "A notice", "of three", "lines", f"more {i}"])) for i in range(50)]
    passages = [[f"p{k} {j}" for j in range(2 + k % 9)] for k in range(30)]
    rows += [(100 + i, "\n".join([f"x{i}", *r.choice(passages), f"y{i}", *r.choice(passages), f"z{i}"])) for i in range(300)]
    out = {x[0]: x for x in got(line_dedup(make_docs(rows)))}
    assert sum(out[i][2] for i in range(50)) == 147 and out[0][2] == 0
    kept = sum(x[1] - x[2] for i, x in out.items() if i >= 100)
    assert kept == 3 * 300 + sum(len(p) for p in passages)


def test_a_line_repeated_or_alternating_in_a_text(make_docs):
    rows = [(1, "\n".join(["same"] * 91)), (2, "\n".join(["tick", "tock"] * 40 + ["end"]))]
    assert got(line_dedup(make_docs(rows))) == brute(rows)
    assert [x[2] for x in brute(rows)] == [86, 78]


def test_one_of_equal_rows_stays(spark, make_docs):
    rows = [(1, "a\nb\nc")] * 3 + [(2, "other\na\nb\nc"), (3, "one")] + [(3, "one")]
    assert [x[2] for x in got(line_dedup(make_docs(rows)))] == [0, 3, 3, 3, 0, 0] and got(line_dedup(make_docs(rows))) == brute(rows)
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(x[2] for x in con.execute(op6_lines.OP6_SQL).fetchall()) == [0, 0, 0, 3, 3, 3]


def test_empty_odd_columns_and_long_text(make_docs):
    assert line_dedup(make_docs([])).collect() == []
    long = "\n".join(f"row {i}" for i in range(50_000))
    rows = [(1, long), (2, "head\n" + long), (3, "x" * 2_000_000)]
    docs = make_docs(rows).withColumn("lines", F.lit(1)).withColumn("pos", F.lit(2)).withColumn("gone", F.lit(3))
    assert got(line_dedup(docs)) == brute(rows)


def test_no_python_in_the_plan(make_docs):
    plan = line_dedup(make_docs([(1, "a\nb")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEvalPython", "Python") and "Pandas" not in plan


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    have = sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in op6_line_dedup(spark, sf).collect()), key=str)
    want = brute([(d.doc_id, d.text) for d in docs])
    assert have == sorted(((a, b, n, hashlib.sha256(k.encode()).hexdigest()) for a, b, n, k in want), key=str)


def test_sql_twin(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(op6_lines.OP6_SQL).fetchall())
    assert sorted(tuple(r) for r in op6_line_dedup(spark, sf).collect()) == want
