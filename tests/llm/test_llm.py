"""The training-data operators against brute force, on small tables with nulls, empty and repeated rows."""

import collections
import hashlib
import os
import random
import re

import compare
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltatlas.llm import arrays as A
from voltatlas.llm import common, line_pairs, substrings
from voltatlas.llm import toxicity as tox
from voltatlas.llm.common import pieces, ready
from voltatlas.llm.hilbert import hilbert_key, nearest, windows
from voltatlas.llm.jaccard import linked
from voltatlas.llm.lines import BUCKETS, SIM_APART, SIM_BITS, _apart, _runs, _signs, _similar, _word_edits, edit_distance, simhash, without_repeated_lines
from voltatlas.llm.mixing import OP5_SQL, mixed, op5_hash_threshold_mix
from voltatlas.llm.packing import LENGTHS, pack, packed
from voltatlas.llm.quality import quality
from voltatlas.llm.repetition import COVERED_PERCENT, LONGEST_REPEAT, REPEAT_WORDS, keep_good, longest_repeats, repetition
from voltatlas.llm.sharding import first_map, placed, rebalanced, slot_map_at
from voltatlas.llm.substrings import without_repeats

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")
COLUMNS = "doc_id long, text string, lang string, source string, size long, id string, h long"


@pytest.fixture
def table(spark):
    ready(spark)

    def make(texts):
        rows = [(i, t, "en", f"s{i % 3}" if i and i % 4 else None, 1, "x", 2) for i, t in texts]
        return spark.createDataFrame(rows, COLUMNS)

    return make


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "é " * 40), (7, "a b"), (7, "a b"), (8, "x" * 70_000)]


def test_every_operator_takes_empty_and_odd_tables(spark, table):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    runs = [
        repetition, linked, mixed, placed, packed, without_repeats, without_repeated_lines, keep_good,
        lambda d: quality(d, labels), lambda d: tox.toxicity(d, labels),
    ]
    empty, odd = table([]), table(ODD)
    for run in runs:
        assert run(empty).count() == 0
        n = run(odd).count()
        # Packing makes pieces of the long text; no odd text passes the rules.
        assert n == (0 if run is keep_good else len(ODD))
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_repetition(table):
    rng = random.Random(4)
    some = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(rng.randint(1, 120))) for _ in range(20)]
    texts = ODD + [(20 + k, t) for k, t in enumerate(some)] + [(50, "\n".join(["a line here", "a line here", " ", "# $ x", "a line here"]))]
    got = repetition(table(texts)).collect()
    for r in got:
        t = next(t for i, t in texts if i == r.doc_id)
        w = words_of(t)
        seen = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cov = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(cov))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t or "") and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 10 or 100 * len(cov) > 20 * len(w)) and not (r.base_failed and r.kept)


def test_repetition_verdict(table):
    """Covered words, longest repeat and verdict against every pair of positions; some texts fall by the suffix array alone."""
    rng = random.Random(11)
    fresh = lambda n, tag: [f"{tag}{k}" for k in range(n)]
    passage, ten = fresh(LONGEST_REPEAT + 5, "p"), fresh(REPEAT_WORDS, "t")
    long = passage + fresh(2000, "x") + passage
    at_limit = passage[:LONGEST_REPEAT] + fresh(2000, "x") + passage[:LONGEST_REPEAT]
    shares = [ten + fresh(n, "y") + ten for n in (82, 88, 91, 92, 100)]
    mixed_up = [[rng.choice("abcdefghijklmnop") for _ in range(rng.randint(12, 90))] for _ in range(8)]
    texts = [(k, " ".join(w)) for k, w in enumerate([long, at_limit, *shares, *mixed_up])]
    alone = 0
    for r in repetition(table(texts)).collect():
        w = words_of(texts[r.doc_id][1])
        n, longest, covered = len(w), 0, set()
        reach = [0] * n
        below = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            row = [0] * (n + 1)
            for j in range(n - 1, i, -1):
                if w[i] == w[j]:
                    row[j] = below[j + 1] + 1
                    reach[i], reach[j] = max(reach[i], row[j]), max(reach[j], row[j])
            below = row
        seen = collections.Counter(tuple(w[k : k + 5]) for k in range(n - 4))
        if max(seen.values()) > 1:  # shorter repeats are not looked for elsewhere
            longest = max(reach)
            covered = {i + k for i, m in enumerate(reach) if m >= REPEAT_WORDS for k in range(m)}
        rejected = 100 * len(covered) > COVERED_PERCENT * n or longest > LONGEST_REPEAT
        assert (r.n_covered, r.longest_repeat, r.kept) == (len(covered), longest, not r.base_failed and not rejected)
        alone += rejected and not r.base_failed
    assert alone >= 2


def test_longest_repeats():
    rng = random.Random(5)
    for _ in range(30):
        w = np.array([rng.randrange(3) for _ in range(60)], np.uint64)
        own = np.repeat([0, 1], 30)
        at, length = longest_repeats(w, own, np.array([True, True]), np.array([30, 60]))
        for i, n in zip(at, length):
            end = 30 if i < 30 else 60
            def lcp(j):
                k = 0
                while max(i, j) + k < end and w[i + k] == w[j + k]:
                    k += 1
                return k
            assert n == max(lcp(j) for j in range(end - 30, end) if j != i)


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_substrings(table, monkeypatch, crowd):
    """With a ``crowd`` of 2, parse suffixes found more than twice are crowded: joined on their own and split."""
    monkeypatch.setattr(substrings, "GROUP_TRIGGERS", crowd)
    monkeypatch.setattr(substrings, "MOST_HOT", 1 << 40)
    rng = random.Random(1)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(0, 500))) for _ in range(15)]
    texts = ODD[:3] + [(9, "a" * 300), (10, "ab" * 150)] + [(20 + k, t) for k, t in enumerate(base)]
    texts += [(50, base[3] + base[4]), (51, base[5]), (52, base[6][:200] + "é" + base[6][200:]), (23, base[3])]
    size = 60
    raw = [(t or "").encode() for _, t in texts]
    seen = collections.Counter(t[i : i + size] for t in raw for i in range(len(t) - size + 1))
    expect = []
    for (i, _), t in zip(texts, raw):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - size + 1):
            if seen[t[k : k + size]] > 1:
                gone[k : k + size] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        expect.append((i, len(t), int(gone.sum()), len(A.runs(gone)[0]), hashlib.sha256(left).hexdigest()))
    assert sorted(map(tuple, without_repeats(table(texts), size).collect())) == sorted(expect)


def test_linked(table):
    rng = random.Random(2)
    voc = [f"w{i}" for i in range(200)]
    texts = ODD[:7]
    base = [[rng.choice(voc) for _ in range(rng.randint(5, 150))] for _ in range(8)]
    for k in range(120):
        w = list(base[k % 8])
        for _ in range(rng.randint(0, max(1, len(w) // 40))):
            w[rng.randrange(len(w))] = rng.choice(voc)
        texts.append((100 + k, " ".join(w)))
    sets = []
    for _, t in texts:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words_of(t)]
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 90 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    expect = sorted((i, len(s), texts[r][0]) for (i, _), s, r in zip(texts, sets, root))
    assert sorted(map(tuple, linked(table(texts)).collect())) == expect


def test_linked_with_null_and_repeated_ids(table):
    """Rows are known by id and text: links of rows with a null id, and of one id with many texts."""
    w = " ".join(f"w{k}" for k in range(60))
    texts = [(None, w), (None, w + " more"), (5, "alone " * 5), (5, w), (5, w + " end"), (9, None), (None, None)] + [(None, f"t{k} " * 4) for k in range(40)]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in linked(table(texts)).collect())
    assert got == collections.Counter(
        [(None, 58, 5), (None, 59, 5), (5, 58, 5), (5, 59, 5), (5, 1, 5), (9, 0, 9), (None, 0, None)] + [(None, 1, None)] * 40
    )


def test_line_bounds_hold():
    """Both bounds keep to their side of the edit distance, and the verdict is the one of the distance."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        one = [b"abcdefghij"[: k + 1] * 2 for k in rng.integers(0, 10, rng.integers(0, 30))]
        two = list(one)
        for _ in range(rng.integers(0, 5)):
            at = rng.integers(0, len(two) + 1)
            two[at : at + rng.integers(0, 3)] = [[], [b"xyz"], [b"q", b"rst"]][rng.integers(0, 3)]
        a, b = b" ".join(one), b" ".join(two)
        exact, most = edit_distance(a, b), max(len(a), len(b))
        assert _apart(a, b) <= exact <= _word_edits(a.split(b" "), b.split(b" "), 10**9)
        assert _similar(a, b, 90) == (100 * (most - exact) >= 90 * most)


def test_simhash_of_runs():
    """Against votes counted one by one; lines alike differ in few bits, others in many."""
    rng = random.Random(6)
    lines = [" ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(k)) for k in (1, 20, 40, 3000)]
    lines += [lines[2][:100] + "x" + lines[2][101:], "abc"]
    buf = np.frombuffer("".join(lines).encode(), np.uint8)
    size = np.array([len(x) for x in lines])
    begin = np.cumsum(size) - size
    got, signs = simhash(buf, begin, size), _signs()
    for row, lo, n in zip(got, begin, size):
        votes = np.zeros(SIM_BITS)
        for code in _runs(buf[lo : lo + n]):
            votes += signs[int(code) >> 64 - 10]
        assert BUCKETS == 1 << 10 and (np.packbits(votes > 0).view(np.uint64) == row).all()
    apart = lambda i, j: int(np.bitwise_count(got[i] ^ got[j]).sum())
    assert apart(2, 4) <= SIM_APART // 2 and apart(1, 2) > SIM_APART


def test_lines(table):
    rng = random.Random(3)
    for _ in range(100):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))).encode() for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        assert edit_distance(a, b) == row[-1]
    line = "the quick brown fox jumps over the lazy dog again and again"
    texts = [(1, f"{line}.\nunique words stand here"), (2, f"{line.upper()}!\nok"), (3, None), (4, ""), (5, "ok\nok")]
    got = {r.doc_id: (r.n_removed, r.kept) for r in without_repeated_lines(table(texts)).collect()}
    assert got == {1: (0, texts[0][1]), 2: (1, "ok"), 3: (0, None), 4: (0, ""), 5: (2, "")}


def test_lines_with_one_change(spark):
    """One word or one letter changed in lines of 8 to 60 words; recall against brute-force edit similarity."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    texts, pairs = [], 0
    for k in range(240):
        w = [word() for _ in range(rng.choice([8, 10, 15, 20, 30, 45, 60]))]
        v, at = list(w), rng.randrange(len(w))
        v[at] = word() if k % 2 else v[at][:1] + "z" + v[at][2:]
        texts += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
        pairs += _similar(texts[-2][1].encode(), texts[-1][1].encode(), 90)
    ready(spark)
    rows = without_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert pairs > 220 and 0.99 * pairs <= sum(r.n_removed for r in rows) <= pairs


def test_lines_lose_no_link(spark):
    """Edits spread evenly over a line up to the last one allowed, and moved stretches: the groups are those of all pairs."""
    rng = random.Random(29)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    lines = ["abcdefghi", "abcdefghix", "abcdefghi xy"]
    for k in range(120):
        line = " ".join(word() for _ in range(rng.choice([2, 4, 8, 15, 30, 60])))
        lines.append(line)
        for least in (0, 1):
            new, edits = list(line), max(1, len(line) // 10 - least)
            for e in range(edits):
                at = min(len(new) - 1, e * len(line) // edits + rng.randrange(4))
                new[at : at + 1] = [["q"], ["q", new[at]], []][rng.randrange(3) if k % 3 else 0]
            lines.append("".join(new))
    plain = [" ".join(x.split()).encode() for x in lines]
    of = {x: x for x in plain}

    def top(x):
        while of[x] != x:
            x = of[x]
        return x

    for i, a in enumerate(plain):
        for b in plain[:i]:
            if 100 * min(len(a), len(b)) >= 90 * max(len(a), len(b)) and top(a) != top(b):
                most = max(len(a), len(b))
                if 100 * (most - edit_distance(a, b)) >= 90 * most:
                    of[max(top(a), top(b))] = min(top(a), top(b))
    ready(spark)
    rows = without_repeated_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    seen = set()
    for x, r in zip(plain, sorted(rows, key=lambda r: r.doc_id)):
        assert r.n_removed == (top(x) in seen), x
        seen.add(top(x))
    assert len(seen) < 250


def test_lines_of_few_words(spark):
    """Exact copies of one and two words, and of texts without blanks, go; a letter changed in them too; other numbers stay."""
    url, han = "https://example.org/" + "abcdefghij" * 4, "这是一个没有空格的很长的中文句子用来测试重复"
    texts = [(1, f"Stteen Erachtz.\n{url}\n{han}\nabcdefghijk\n2019"), (2, f"stteen erachtz\n{url}\n{han}\nabcdefxhijk\n2020")]
    texts += [(3, url.replace("abcdefghij", "abcdefghiz", 1)), (4, han + "吗"), (5, "abcdeghijk")]
    ready(spark)
    got = {r.doc_id: r.kept for r in without_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: texts[0][1], 2: "2020", 3: "", 4: "", 5: ""}


def test_lines_of_rows_with_one_id(spark):
    """Null ids and an id with two texts: each row keeps its own unique lines, and repeats go."""
    same, own = "this very line stands in all of the rows", [f"only row number {w} has words like {w * 4}" for w in ("ax", "by", "cz", "dw", "ev")]
    texts = [(None, f"{own[0]}\n{same}"), (None, f"{own[1]}\n{same}"), (None, f"{same}\n{own[2]}"), (9, f"{same}\n{own[3]}"), (9, f"{own[4]}\n{same}")]
    ready(spark)
    rows = without_repeated_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert collections.Counter(x for r in rows for x in r.kept.split("\n") if x) == collections.Counter([same, *own])


def test_near_duplicates_of_rows_with_one_id(spark):
    import corpus_pipeline

    twin, other, third = (" ".join(f"{c}{k}" for k in range(40)) for c in "xyz")
    texts = [(1, twin), (2, twin), (2, other), (None, third), (None, third + " end"), (None, twin + " end")]
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(texts, "doc_id long, text string"), "").collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in left) == [(0, "z"), (1, "x"), (2, "y")]


CLASHING = "doc_id long, text string, lang string, source string, " + ", ".join(
    f"{n} long" for n in "size h of target whole below kept n_lines n_removed row_key row component_id drop in_3 copies copy part piece line".split()
)


@pytest.mark.parametrize("name", ["quality_rules", "line_dedup", "near_duplicates", "source_mix", "packing"])
def test_stages_take_odd_tables(spark, name):
    """Columns that clash with the stages' own come through; null and empty texts and empty tables do no harm."""
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)[name]
    n = len(CLASHING.split(",")) - 4
    rng = random.Random(1)
    clean = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 9) for _ in range(40)) for _ in range(12)]
    texts = [(k, t) for k, t in enumerate(clean)] + [(None, None), (20, ""), (20, ""), (21, clean[0])]
    rows = [(i, t, "en", f"s{k % 2}" if k % 5 else None, *range(n)) for k, (i, t) in enumerate(texts)]
    out = stage(spark, spark.createDataFrame(rows, CLASHING), "").collect()
    if name != "packing":
        assert all(tuple(r)[4:] == tuple(range(n)) for r in out) and list(out[0].__fields__) == [c.split()[0] for c in CLASHING.split(", ")]
        left = collections.Counter(r.text for r in out if r.text)
        once = [t for t in clean if left[t] >= 1]
        assert len(once) == 12 or name == "source_mix"
        assert name == "source_mix" or left[clean[0]] == (2 if name == "quality_rules" else 1)
    assert stage(spark, spark.createDataFrame([], CLASHING), "").count() == 0


@here
def test_mix_agrees_with_sql(spark):
    assert compare.difference(op5_hash_threshold_mix(spark, SF), compare.connect(SF), OP5_SQL) is None


def test_shards(spark, table):
    rng = random.Random(6)
    rows = placed(table([(i, "y" * rng.randint(0, 400)) for i in range(2000)]), 8).collect()
    load = collections.Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) < 1.02 * min(load.values())
    for shard in range(8):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    sizes = spark.range(64).select(F.col("id").cast("int").alias("vslot"), (F.col("id") * 7 % 13 + 1).alias("bytes"))
    old = {r.vslot: r.shard for r in first_map(spark, 4, 64).collect()}
    new = {r.vslot: r.shard for r in rebalanced(first_map(spark, 4, 64), sizes, 5, only_new=True).collect()}
    assert len(new) == 64 and {s for v, s in new.items() if s != old[v]} == {4}


def test_shards_of_one_record_given_often(table):
    """Law ``bytes`` with a third of the rows alike, with one id for many texts, and with null ids."""
    alike = [(i, "y" * (i % 300)) for i in range(2000)] + [(None, "same text " * 30)] * 1000
    one_id = [(7, f"text {i} " * 20) for i in range(1000)] + [(i, "z" * 100) for i in range(2000)]
    for texts in (alike, one_id, [(None, None)] * 600):
        rows = placed(table(texts).repartition(4), 8).collect()
        load = collections.Counter()
        for r in rows:
            load[r.shard] += r.size
        assert len(rows) == len(texts) and len(load) == 8 and max(load.values()) < 1.1 * min(load.values())
        for shard in range(8):
            assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_stored_slot_maps(spark, table, tmp_path):
    """Each run edits the newest version; all versions stay, and slots that need not move stay where they are."""
    maps = str(tmp_path / "maps")
    assert slot_map_at(spark, maps) is None
    first = placed(table([(i, "a" * (i % 50)) for i in range(900)]), 6, 128, maps).count()
    placed(table([(i, "a" * (i % 50)) for i in range(990)]), 6, 128, maps).count()
    at = [{r.vslot: r.shard for r in slot_map_at(spark, maps, v).collect()} for v in (1, 2, 3)]
    assert first == 900 and all(set(range(128)) <= set(m) for m in at) and slot_map_at(spark, maps).first().version == 3
    moved = lambda a, b: sum(a[v] != b[v] for v in range(128))
    assert 0 < moved(at[1], at[2]) < 64 and at[0] == {v: v % 6 for v in range(128)}


def test_packing(table):
    rng = random.Random(7)
    sizes = [rng.randint(1, LENGTHS[-1]) for _ in range(500)]
    number, offset, length = pack(sizes)
    for b, cap in enumerate(length):
        spans = sorted((offset[i], sizes[i]) for i in range(500) if number[i] == b)
        assert all(a + n == c for (a, n), (c, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= cap
        assert cap == LENGTHS[0] or sum(spans[-1]) > LENGTHS[LENGTHS.index(cap) - 1]
    texts = ODD + [(30, " ".join(f"w{k}" for k in range(5000)))]
    back = collections.defaultdict(list)
    for r in packed(table(texts), with_text=True).collect():
        back[r.doc_id].append((r.piece, r.part))
    assert "".join(p for _, p in sorted(back[30])) == texts[-1][1] and len(back[30]) == 3 and len(back[7]) == 2


def test_hilbert_and_neighbours(spark):
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    walk = grid[np.argsort(hilbert_key(grid, 3))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[100:140] = x[7]  # a group of equal vectors
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in nearest(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    d = x.astype(float)
    hits = 0
    for q in range(0, 400, 20):
        true = sorted((-(d[q] * d[j]).sum(), j) for j in range(400) if j != q)[:20]
        assert len(got[q]) == 20
        hits += len({j for _, j in true} & set(got[q]))
    assert hits >= 0.9 * 400


@pytest.mark.parametrize("n", [1, 10, 21, 30, 90])
def test_all_neighbours_of_small_tables(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 6))
    table = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    ready(spark)
    got = collections.defaultdict(list)
    for r in nearest(table, F.col("vec_id") % 3 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    for q in range(0, n, 3):
        assert got[q] == sorted((j for j in range(n) if j != q), key=lambda j: (-(x[q] * x[j]).sum(), j))[:20]


def test_windows_hold_their_rows():
    rng = np.random.default_rng(2)
    sizes = [(c, 10 * c + b, int(rng.integers(1, 30))) for c in range(2) for b in range(10)]
    for curve, block, low, high in windows(sizes, 25):
        n = {b: n for c, b, n in sizes if c == curve}
        assert low == min(n) or sum(n[b] for b in range(low, block)) >= 25
        assert high == max(n) or sum(n[b] for b in range(block + 1, high + 1)) >= 25


def test_classifiers_learn(spark, table):
    rng = random.Random(9)
    voc = [f"wort{i}" for i in range(80)]
    texts, labels = [], []
    for i in range(400):
        w = [rng.choice(voc) for _ in range(30)]
        bad, rude = i % 4 == 0, i % 5 == 0
        w = [x + "***" for x in w] if bad else w
        if rude:
            w[3] = "idiot"
        texts.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(rude)))
    docs, known = table(texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for out, k in ((quality(docs, known), 1), (tox.toxicity(docs, known), 2)):
        held = [r for r in out.collect() if r.held_out]
        assert np.mean([r.predicted == labels[r.doc_id][k] for r in held]) >= 0.95


def test_counterfactuals_lower_the_weight_of_groups():
    rng = random.Random(10)
    text = lambda term, rude: f"{rng.choice('abcdefgh') * 3} {term} {'idiot' if rude else 'people'} {rng.choice('abcdefgh') * 4}".encode()
    rows = [(text("muslim", True), 1) for _ in range(60)] + [(text("christian", False), 0) for _ in range(60)] + [(text("poor", True), 1) for _ in range(30)]
    x, y = [t for t, _ in rows], np.array([v for _, v in rows])
    def gap(strength):
        w = tox.train(x, y, strength)
        _, idx, _ = tox.features([b"muslim"])
        _, other, _ = tox.features([b"christian"])
        return abs(w[idx].sum() - w[other].sum())
    assert gap(1.0) < 0.5 * gap(0.0)


def test_pieces_hold_every_row():
    texts = [None, b"x" * 5, b"", b"y" * 50, b"z"]
    assert [r for lo, hi in pieces(texts, 10) for r in range(lo, hi)] == list(range(5))


def test_lines_leave_no_large_tables(spark, monkeypatch, tmp_path):
    """The tables of keys, texts and blocks go as soon as no later job reads them, and a line's occurrences go on without keys."""
    made = []
    monkeypatch.setattr(common, "scratch_dir", lambda _, purpose: made.append(tmp_path / f"{purpose}-{len(made)}") or str(made[-1]))
    texts = [(1, "one line of some words here\nanother line"), (2, "one line of some words herr\nanother line"), (3, None)]
    rows = without_repeated_lines(ready(spark).createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {1: 0, 2: 2, 3: 0}
    left = {p.name.rsplit("-", 1)[0] for p in made if p.exists()}
    assert len(made) > 10 and not left & {"line-marks", "line-keyed", "line-texts", "line-blocks"}


def test_blocks_hold_each_line_once():
    """A text that comes several times is one line; a line takes the group that comes before it, and large groups lie apart."""
    rows = [(1, 0, 1, None, None, b"abcdefghijk"), (1, 0, 1, None, None, b"abcdefghijk"), (1, 0, 3, 9, None, None), (1, 0, 3, None, None, b"abcdefghijx")]
    rows += [(1, 0, k, *r) for k in range(10, 40) for r in ((7, 7, None), (None, None, b"abcdefghij%02d" % k))]
    rows += [(1, 1, 50, None, None, b"abcdefghijk"), (1, 1, 51, 7, 7, None), (1, 1, 51, None, None, b"abcdefghi51")]
    names = ["size", "place", "h", "root", "own", "plain"]
    kinds = pa.schema([(n, pa.binary() if n == "plain" else pa.int64()) for n in names])
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[k : k + 5]], kinds) for k in range(0, len(rows), 5)]
    blocks = [b.to_pylist()[0] for b in line_pairs._cut(batches)]
    got = [(b["own"], np.frombuffer(b["h"], np.int64).tolist(), np.frombuffer(b["root"], np.int64).tolist()) for b in blocks]
    assert got == [(None, [1, 3], [1, 9]), (7, list(range(10, 40)), [7] * 30), (None, [50, 51], [50, 7])]


def test_shared_runs_show_all_similar_lines():
    """Pairs of blocks against all pairs, with edits spread evenly, in texts of few syllables and of long lines."""
    rng = random.Random(41)
    for size in (12, 45, 130, 600):
        lines = ["".join(rng.choice(["an", "the", "on ", "er", "st ", "ou"]) for _ in range(size))[:size] for _ in range(12)]
        for line in lines[:8]:
            edits = max(1, size // 10)
            changed = list(line)
            for e in range(edits):
                changed[e * size // edits] = rng.choice(["", "z"]) if e % 2 else "q"
            lines.append("".join(changed))
        lines = sorted({x.encode() for x in lines}, key=lambda x: (len(x), x))
        h = np.arange(len(lines), dtype=np.int64)
        block = line_pairs._Block(h, h, np.array([len(x) for x in lines]), b"".join(lines))
        found = {(int(i), int(j)) for y, x in line_pairs._shared(block, block, 90) for i, j in zip(y, x)}
        near = {(i, j) for j in range(len(lines)) for i in range(j) if _similar(lines[i], lines[j], 90)}
        assert len(near) >= 4 and near <= found
        assert len(block.index(min(9, size // 4))[0]) == sum(max(0, len(x) - min(9, size // 4) + 1) for x in lines)


def test_blocks_met_again_are_opened_once(monkeypatch):
    """Blocks on the right are held for the next one on the left; with any limits, what is similar is found."""
    rng = random.Random(43)
    lines = sorted({"".join(rng.choice(["an", "the", "on ", "er", "st ", "ou"]) for _ in range(90))[:90] for _ in range(60)})
    lines += ["q" + x[1:40] + x[41:70] + "zz" + x[70:] for x in lines[:30]]
    plain = [x.encode() for x in lines]
    parts = [sorted((len(plain[k]), k) for k in range(len(plain)) if k % 4 == r) for r in range(4)]
    blocks = [line_pairs._block([(k, None, k, n, plain[k]) for n, k in part]).to_pylist()[0] for part in parts]
    pairs = [{**a, **{"r_" + c: v for c, v in b.items()}} for a in blocks for b in blocks]
    near = {(i, j) for i in range(len(plain)) for j in range(i) if _similar(plain[i], plain[j], 90)}
    opened, decompress = [], pa.decompress
    monkeypatch.setattr(line_pairs.pa, "decompress", lambda *a, **k: opened.append(1) or decompress(*a, **k))
    for limits in ({}, {"CROWD": 0}, {"HITS": 50}, {"CROWD": 1, "HITS": 50, "HELD_BYTES": 0}):
        opened.clear()
        with monkeypatch.context() as m:
            for name, value in limits.items():
                m.setattr(line_pairs, name, value)
            batches = iter([pa.RecordBatch.from_pylist([p]) for p in pairs])
            links = [(r["a"], r["b"]) for b in line_pairs._links(90, _similar, batches) for r in b.to_pylist()]
        root = list(range(len(plain)))
        for a, b in links:
            assert _similar(plain[a], plain[b], 90)
            root = [root[a] if r == root[b] else r for r in root]
        assert len(near) >= 30 and all(root[i] == root[j] for i, j in near)
        assert len(opened) == (len(blocks) * (len(blocks) + 1) if "HELD_BYTES" in limits else 2 * len(blocks))
