"""Language identification, importance resampling and spelling variants against brute force and SQL."""

import collections
import hashlib
import math
import os
import re
import zlib

import compare
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voltatlas.llm import language, spelling
from voltatlas.llm.checksums import crc32
from voltatlas.llm.common import ready
from voltatlas.llm.importance import OP12_SQL, cut_key, gains, op12_median_resample, resampled
from voltatlas.llm.spelling import OP13_SQL, op13_partenum_spelling, spellings, variants

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")
# Names that the operators use themselves.
COLUMNS = "doc_id long, text string, lang string, a long, word string, n long, key long, rank long, score double"
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture
def table(spark):
    ready(spark)
    return lambda rows: spark.createDataFrame([(i, t, lang, 1, "w", 2, 3, 4, 0.5) for i, t, lang in rows], COLUMNS)


def test_checksums_of_stretches():
    buf = np.frombuffer(bytes(range(256)) * 3, np.uint8)
    start, end = np.array([0, 5, 9, 100, 7]), np.array([0, 6, 40, 700, 71])
    assert crc32(buf, start, end).tolist() == [zlib.crc32(buf[a:b].tobytes()) for a, b in zip(start, end)]
    before = np.array([zlib.crc32(b"x%d" % k) for k in range(5)], np.uint32)
    assert crc32(buf, start, end, before).tolist() == [zlib.crc32(b"x%d" % k + buf[a:b].tobytes()) for k, (a, b) in enumerate(zip(start, end))]


# Importance resampling.

DOCS = [(1, None, None), (2, "", None), (3, " \n", None), (None, "Apple pie " * 12, None), (None, None, None), (4, "é1 b-c " * 15, None)]
DOCS += [(5, "same words here " * 8, None)] * 5 + [(5, "other words here " * 8, None)]
DOCS += [(10 + k, f"word{k % 7} apple {'pie ' * (k % 5)}" * 7, None) for k in range(80)] + [(99, "long " * 30_000, None)]


def expected(docs, target, n, buckets, seed, percent, least):
    def runs(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[k : k + m]).encode()) % buckets for m in range(1, n + 1) for k in range(len(w) - m + 1)]

    s, t = collections.Counter(), collections.Counter()
    found = [(i, *runs(x)) for i, x, _ in docs]
    for _, _, f in found:
        s.update(f)
    for x in target:
        t.update(runs(x)[1])
    big, small = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[k] + 1) * (big + buckets) / ((s[k] + 1) * (small + buckets)))) for k in range(buckets)]
    out = []
    for i, words, f in found:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[k] for k in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    asked = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(asked[: percent * len(asked) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("n, percent, small", [(1, 10, 4096), (2, 33, 5), (1, 0, 4096)])
def test_resampling_against_brute_force(table, n, percent, small):
    target = ["apple pie", None, "", "word3 apple"]
    got = resampled(table(DOCS).repartition(5), table([(k, t, None) for k, t in enumerate(target)]), range(1, n + 1), 50, 7, percent, 20, small)
    assert sorted(map(tuple, got.collect()), key=str) == expected(DOCS, target, n, 50, 7, percent, 20)


def test_resampling_of_empty_tables(table):
    assert resampled(table([]), table([])).count() == 0
    got = resampled(table(DOCS), table([])).collect()
    assert len(got) == len(DOCS) and sum(r["rank"] is not None for r in got) == 7
    assert not gains(np.zeros(5, np.int64), np.zeros(5, np.int64)).any()


def test_cut_by_medians(spark):
    rng = np.random.default_rng(3)
    rows = [(int(a), int(b), c) for c, (a, b) in enumerate(zip(rng.integers(0, 6, 500), rng.integers(0, 4, 500)))]
    keys = spark.createDataFrame(rows, "a long, b long, c long").repartition(7)
    order = sorted(rows)
    for k in (1, 137, 500):
        assert cut_key(keys, k, 3) == order[k - 1]
    assert cut_key(keys, 501) is None and cut_key(keys, 0) is None


@here
def test_resampling_against_sql(spark):
    assert compare.difference(op12_median_resample(spark, SF), compare.connect(SF), OP12_SQL) is None


# Spelling variants.


def brute(docs, least, times, ratio, slip):
    seen = collections.Counter()
    for i, t in docs:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % slip == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            seen[r] += len(r) >= least
    words = {w: n for w, n in seen.items() if n >= times}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(b) - len(a) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    form, found = {}, {w: [x for x in words if near(w, x)] for w in words}
    for w, others in found.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= ratio * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(found[w]), words.get(form.get(w))))
    return sorted(out)


WORDS = ["spelling", "speling", "spellinge", "sppelling", "spelline", "anagrams", "margaans", "établir", "etablir", "étâblir", "ÉTABLIR", "x" * 90, "x" * 91]
TEXTS = [(1, None), (2, ""), (3, "12 ? short"), (None, "Spelling, spelling; SPELLING! speling " * 9), (None, None)]
TEXTS += [(10 + k, " ".join(w if (k + j) % 3 else w.upper() for j, w in enumerate(WORDS[: 1 + k % len(WORDS)]))) for k in range(60)]
TEXTS += [(7, "spelling÷times×over " * 40)] * 3 + [(8, "spellingspellin " * 300 + "spellingspelling " * 20 + "spelingspelling " * 2)]


@pytest.mark.parametrize("slip, ratio", [(31, 10), (2, 2)])
def test_spellings_against_brute_force(table, slip, ratio):
    got = spellings(table([(i, t, None) for i, t in TEXTS]), ratio=ratio, slip=slip)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(TEXTS, 7, 2, ratio, slip), key=str)


@pytest.mark.parametrize("pairwise", [1, 1000])
def test_groups_compared_by_pairs_or_by_what_is_left_out(spark, pairwise):
    """Crowded groups: words of three letters, all of whose neighbours are there."""
    rng = np.random.default_rng(pairwise)
    words = {"aaaaaaa" + "".join(rng.choice(list("abé"), rng.integers(1, 5))) for _ in range(150)} | {"aabaa" + x for x in ("aaa", "aab", "baaa", "aaab")}
    counted = [(w, int(n)) for w, n in zip(sorted(words), rng.integers(2, 200, len(words)))]
    got = variants(spark.createDataFrame(counted, "word string, n long"), ratio=3, pairwise=pairwise).collect()
    text = " ".join(w for w, n in counted for _ in range(n))
    assert sorted(map(tuple, got), key=str) == sorted(brute([(0, text)], 7, 2, 3, 1 << 40), key=str)


def test_spellings_of_empty_tables(table):
    assert spellings(table([])).count() == 0 and spellings(table([(1, "a b c", None)])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcéÿ×", min_size=7, max_size=12), min_size=1, max_size=6))
def test_words_as_letters_and_back(words):
    import pyarrow as pa

    letters, size = spelling.letters_of(pa.array(words))
    assert letters.tobytes() == "".join(words).encode("latin-1") and size.tolist() == [len(w) for w in words]
    assert spelling.strings(letters, size).to_pylist() == words


@settings(max_examples=80, deadline=None)
@given(st.text("abcdé", min_size=7, max_size=11), st.integers(0, 10), st.sampled_from("abxé"))
def test_one_edit_leaves_a_signature(word, at, letter):
    """Words one edit apart share a part of the letter vector and a half."""
    import pyarrow as pa

    at = min(at, len(word) - 1)
    for other in (word[:at] + letter + word[at + 1 :], word[:at] + letter + word[at:]):
        if other != word:
            letters, size = spelling.letters_of(pa.array([word, other]))
            parts = spelling.signatures(letters, size)
            half = spelling.halves(letters, size, np.full(2, len(word)))
            assert (parts[0] == parts[1]).any() and (half[0] == half[1]).any()


@here
def test_spellings_against_sql(spark):
    assert compare.difference(op13_partenum_spelling(spark, SF), compare.connect(SF), OP13_SQL) is None


# Languages.

SAYS = {
    "xx": "the quick brown fox jumps over the lazy dog and then sleeps in the shade of that tree".split(),
    "yy": "der schnelle braune fuchs springt über den faulen hund und schläft dann im schatten eines baums".split(),
    "zz": "le vif renard brun saute par-dessus le chien paresseux puis dort à l'ombre de cet arbre là".split(),
}


def spoken(n=120):
    rng = np.random.default_rng(8)
    return [(k, " ".join(rng.choice(SAYS[lang], 25)), lang) for k in range(n) for lang in [list(SAYS)[k % 3]]]


ODD = [(900, None, "xx"), (901, "", "xx"), (902, "12 !? 34", "yy"), (903, "x" * 60_000, None), (None, "the lazy dog", "zz"), (904, "東京 東京", None), (905, "ÜBER", None)]


def test_languages(table):
    rows = spoken() + ODD + [(1, "der hund", "xx")] * 2
    got = [r.asDict() for r in language.languages(table(rows)).collect()]
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, _, lang in spoken():
        if i != 1:
            assert by_id[i]["lang_pred"] == lang and 0 < by_id[i]["score"] <= 1
            assert by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    for i in (900, 901, 902):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert by_id[None]["held_out"] is False and by_id[904]["lang_pred"] in SAYS
    assert by_id[903]["rejected"] and by_id[904]["rejected"] and by_id[905]["lang_pred"] == "yy"
    named = {r.doc_id: r.lang_pred for r in language.languages(table(rows), rejected_as="??").collect()}
    assert named[904] == "??" and named[0] == "xx" and named[900] == "und"


def test_languages_of_empty_tables(table):
    assert language.languages(table([])).count() == 0
    got = language.languages(table([(1, "some text", None), (2, None, "xx")])).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_vectors_and_rarity_against_brute_force(spark, table):
    texts = ["The Quick fox, ÀÉÿ 12", "", "a b", "aaaa aaa", "über — ß"]

    def grams(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in t)
        words = re.findall(rb"[a-z\x80-\xff]+", low.encode())
        out = collections.Counter()
        for w in words:
            p = b" " + w + b" "
            for n in (1, 2, 3):
                for k in range(len(p) - n + 1):
                    g = p[k : k + n]
                    if g.strip(b" ") and not (n == 3 and g[1:2] == b" ") and g != b" ":
                        code = int.from_bytes(g, "big") | {1: 0, 2: 1 << 24, 3: 2 << 24}[n]
                        out[int(language.A.mix(np.array([code], np.uint64))[0] >> np.uint64(64 - language.BITS))] += 1
        # A word's closing blank is the next word's opening one; both runs count.
        return out

    expect = [grams(t) for t in texts]
    own, bucket, n = language.counts([t.encode() for t in texts])
    got = [collections.Counter() for _ in texts]
    for o, b, c in zip(own.tolist(), bucket.tolist(), n.tolist()):
        got[o][b] += c
    assert got == expect
    idf = language.rarity(table([(k, t, None) for k, t in enumerate(texts)]))
    some = next(iter(expect[0]))
    assert idf[some] == pytest.approx(math.log((1 + len(texts)) / (1 + sum(some in e for e in expect))) + 1)
    own, bucket, value = language.vectors([t.encode() for t in texts], idf)
    mine = {b: (1 + math.log(c)) * idf[b] for b, c in expect[0].items()}
    length = math.sqrt(sum(v * v for v in mine.values()))
    for b, v in zip(bucket[own == 0].tolist(), value[own == 0].tolist()):
        assert v == pytest.approx(mine[b] / length)


@here
def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.op11_centroid_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
