"""Each operator against brute force on rows with nulls, ties, repeats, clashing columns, and on no rows."""

import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm import chat, decontam, quality, tokenbin, toxicity
from tidewatch.llm import common as shared
from tidewatch.llm.decontam import WINDOW, clean, overlaps
from tidewatch.llm.exact_dedup import directory, distinct_documents, exact_groups
from tidewatch.llm.licenses import scan
from tidewatch.llm.near_dedup import near_groups, one_of_each
from tidewatch.llm.packing import pack, plan
from tidewatch.llm.queries import tokenizer
from tidewatch.llm.repeats import remove_repeats
from tidewatch.llm.tokens import Encoder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, rep long, entry long, n long, node long, sketch string, key int, hash string"


def docs_of(spark, rows):
    """Documents with columns that are named like the operators' own."""
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), True, 1, 1, 1, 1, "x", 1, "h") for d, t in rows], EXTRA)


LETTERS = "abcdefghijklmnopqrstuvwxyz\u00e4\u00f6\u00fc"


@pytest.fixture(scope="module")
def enc():
    return Encoder(tokenizer())


@pytest.fixture(scope="module")
def odd_rows():
    """Null, empty, very long, repeated rows, case twins, accents, and a null doc_id."""
    long = " ".join(f"w{i % 997}" for i in range(20_000))
    return [(1, None), (2, ""), (3, "Hello World, this is one"), (4, "hello world, this is one"), (5, "hello world, this is one"), (5, "hello world, this is one"), (6, long), (7, long + " end"), (8, "É é 日本 😀 <|endoftext|>"), (9, "é é 日本 😀 <|endoftext|>"), (None, "a b"), (10, "   \n\t ")]


def ids_of(enc, text):
    return [*enc.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ast' \n\t1!é　 日😀\x00'")) | st.characters(codec="utf-8"), max_size=30), max_size=6))
def test_ids_are_the_librarys(texts):
    e = ids_are.setdefault("e", Encoder(tokenizer()))
    got = [ids[a:b].tolist() for _, ids, o in e.batches(pa.array(texts, pa.string())) for a, b in zip(o[:-1], o[1:], strict=True)]
    assert got == [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]


ids_are = {}


def test_added_tokens_are_the_librarys(enc):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer())
    texts = ["<|endoftext|>", "a<|endoftext|> b", "x <|endoftext|><|endoftext|>'s", "<|endof", "text|>", "<|endoftext", "é<|endoftext|>\n\n", ""]
    got = [ids[a:b].tolist() for _, ids, o in enc.batches(pa.array(texts)) for a, b in zip(o[:-1], o[1:], strict=True)]
    assert got == [x.ids for x in own.encode_batch(texts, add_special_tokens=False)] and got[0] == [50256]


def test_words_seen_before_are_not_encoded_again(monkeypatch):
    """Half a million distinct words, as a task's texts have them, go through the model once each."""
    e, seen = Encoder(tokenizer()), []

    class Counted:
        tokenize = staticmethod(lambda word, model=e.model: seen.append(word) or model.tokenize(word))

    monkeypatch.setattr(e, "model", Counted)
    texts = ["".join(f" {chr(97 + k)}{a}{b}{c}" for a in LETTERS for b in LETTERS for c in LETTERS) for k in range(18)]
    first = [ids.copy() for x in texts for _, ids, _ in e.batches(pa.array([x]))]
    n = len(seen)
    again = [ids.copy() for x in texts for _, ids, _ in e.batches(pa.array([x]))]
    assert n == len(set(seen)) == len(seen) == 18 * len(LETTERS) ** 3 and all((a == b).all() for a, b in zip(first, again, strict=True))


def test_other_tokenizers_go_through_the_library():
    from tokenizers import Tokenizer

    path, texts = tokenizer("word_bpe_49k.json"), ["Hello  World", "", "it's <|endoftext|> ok"]
    e = Encoder(path)
    assert not e.cuts_here
    got = [ids[a:b].tolist() for _, ids, o in e.batches(pa.array(texts)) for a, b in zip(o[:-1], o[1:], strict=True)]
    assert got == [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_contractions_and_spaces(enc):
    texts = ["I'm don't we'll 'tis ''s ' s", "a  b   c ", "x'", "'", "  ", "it's\n\n  it'd", "the'rest 'd"]
    got = [ids[a:b].tolist() for _, ids, o in enc.batches(pa.array(texts)) for a, b in zip(o[:-1], o[1:], strict=True)]
    assert got == [x.ids for x in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


# 1 --------------------------------------------------------------------------------------------


def test_snapshots_collapse(spark):
    rows = []
    talk = [("user", "a"), ("assistant", "b"), ("user", "c")]
    for conv, turns in {1: talk[:1], 2: talk[:2], 3: talk, 4: talk, 5: [("user", "x")], 6: [("user", None)], 7: [("user", "a"), ("assistant", "z")], None: [("user", "n")]}.items():
        rows += [(conv, k, r, t, "clash") for k, (r, t) in enumerate(turns)]
    rows.append((5, 0, "user", "x", "again"))
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.maximal(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, hash string")).collect()}
    assert set(got) == {3, 5, 6, 7, None}
    assert got[3][:2] == (3, 2) and got[5] == (1, 1, "<|user|>\nx<|end|>\n") and got[6][2] == "<|user|>\n<|end|>\n"


def test_snapshots_of_odd_turns(spark):
    """Null and tied turn numbers, repeated rows, and one conversation of very many turns."""
    rows = [(1, None, "user", "z"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "b"), (3, 0, "user", "a")]
    rows += [(9, k, "user", str(k % 7)) for k in range(30_000)] + [(8, k, "user", str(k % 7)) for k in range(29_999)] + [(7, k, "user", str(k % 7)) for k in range(30_000)]
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.maximal(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    turn = "<|user|>\n{}<|end|>\n".format
    assert set(got) == {1, 2, 7} and got[7][:2] == (30_000, 2) and got[7][2] == "".join(turn(k % 7) for k in range(30_000))
    assert got[1] == (3, 1, turn("z") + turn("a") + turn("b")) and got[2] == (2, 1, turn("a") + turn("b"))


def test_snapshots_of_nothing(spark):
    assert chat.maximal(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# 2 --------------------------------------------------------------------------------------------


def test_packing(spark, enc, odd_rows):
    got = pack(docs_of(spark, odd_rows), tokenizer()).collect()
    want = collections.Counter((d, tuple(ids_of(enc, t))) for d, t in odd_rows)
    seqs, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for spans in seqs.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 1024
    for doc, rows in pieces.items():
        for ids, n in [(i, c) for (d, i), c in want.items() if d == doc]:
            cuts = {(r.piece, r.start, r.length, r.ids_crc32) for r in rows}
            first = len(ids) % 1024 or min(1024, len(ids))
            at, k = 0, 0
            while at < len(ids):
                size = first if k == 0 else 1024
                assert (k, at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes())) in cuts
                at, k = at + size, k + 1
            assert sum(r.piece == 0 for r in rows) >= n
    least = math.ceil(sum(r.length for r in got) / 1024)
    assert len(seqs) <= least + 1


def test_packing_nothing(spark):
    assert pack(docs_of(spark, []), tokenizer()).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 9), max_size=12))
def test_plans_use_every_piece_once(counts):
    left = collections.Counter(counts)
    for pattern, times in plan(counts, 64):
        assert sum(s * k for s, k in pattern) <= 64 and times > 0
        for s, k in pattern:
            left[s] -= k * times
    assert not any(left.values())


def test_two_pieces_replace_the_smallest():
    # Greedy filling takes 6 then 3; 2 + 2 fit the gap of 4 that the 3 would leave.
    bins = plan({6: 1, 3: 1, 2: 2}, 10)
    assert ([(6, 1), (2, 2)], 1) in bins


# 3 --------------------------------------------------------------------------------------------


def brute_overlaps(docs, items):
    out = {}
    fold = lambda t: WORD.findall((t or "").translate(LOWER))
    for item, text in items:
        it = fold(text)
        if len(it) < 4:
            continue
        w = min(WINDOW, len(it))
        for doc, body in docs:
            dw = fold(body)
            for diag in range(-len(it), len(dw)):
                same = [0 <= diag + j < len(dw) and dw[diag + j] == it[j] for j in range(len(it))]
                for a in range(len(it) - w + 1):
                    n = sum(same[a : a + w])
                    if n >= math.ceil(0.75 * w):
                        key = (-n, max(0, diag + a))
                        out[doc, item] = min(out.get((doc, item), key), key)
    return {k: (-n, at) for k, (n, at) in out.items()}


def test_a_words_hash_is_made_once(spark, monkeypatch):
    """Seeds are made of the words' hashes: no string is read again for each seed that it stands in."""
    plans = {}
    kept = decontam.scratch
    monkeypatch.setattr(decontam, "scratch", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and kept(df, name))
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string")
    assert overlaps(docs_of(spark, [(1, "zero One two three FOUR five six seven eight nine")]), bench).count() == 1
    assert plans["hits"].count("regexp_extract_all") == 1
    for plan in plans.values():
        assert re.search(r"transform\([^\n]*lambdafunction\(xxhash64\(lambda [^,()]+, 42\)", plan)


def test_overlaps(spark):
    rng = random.Random(4)
    words = [f"v{i}" for i in range(200)]
    items = [(k, " ".join(rng.choices(words, k=n))) for k, n in enumerate([30, 20, 16, 12, 7, 5, 3])] + [(90, None), (91, ""), (2, None)]
    docs = [(1, None), (2, ""), (3, " ".join(rng.choices(words, k=80)))]
    for k in range(40):
        it = rng.choice(items[:6])[1].split()
        for j in range(0, len(it), rng.choice([5, 6, 7, 100])):
            it[j] = rng.choice(words)
        cut = rng.randint(0, 3)
        docs.append((10 + k, " ".join([*rng.choices(words, k=rng.randint(0, 9)), *it[cut:], *rng.choices(words, k=5)]).upper()))
    found = {(r.doc_id, r.item_id): (r.n_same, r.first_word) for r in overlaps(docs_of(spark, docs), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, diagonal int")).collect()}
    want = brute_overlaps(docs, items)
    assert len(want) > 25 and set(found) <= set(want)
    assert len(found) >= 0.95 * len(want)
    assert all(found[k] == want[k] for k in found)


def test_items_of_few_words_count_as_a_whole(spark):
    items = [(1, "blue owl"), (2, "grey"), (3, "one two three"), (4, "one two six seven"), (5, "!!")]
    docs = [(1, "a blue owl sat"), (2, "Grey, blue"), (3, "one two three"), (4, "one two"), (5, "x one two six seven y"), (6, "owl blue")]
    found = {(r.doc_id, r.item_id, r.n_same, r.first_word) for r in overlaps(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {(1, 1, 2, 1), (2, 2, 1, 0), (3, 3, 3, 0), (5, 4, 4, 1)}


def test_clean_documents_stay(spark):
    docs = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "nothing of it is here at all today my friend"), (None, "x"), (3, None)]
    bench = spark.createDataFrame([(7, "two three four five six seven eight nine ten eleven")], "item_id long, text string")
    out = clean(docs_of(spark, docs), bench)
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 2, 3] and out.columns[:2] == ["doc_id", "text"]
    assert overlaps(docs_of(spark, []), bench).count() == 0
    assert overlaps(docs_of(spark, docs), spark.createDataFrame([], "item_id long, text string")).count() == 0


# 4 --------------------------------------------------------------------------------------------


def kneser_ney(texts):
    """The model again, with tuples of symbols for n-grams and dictionaries for tables."""
    n, size = quality.ORDER, quality.SYMBOLS
    levels = {n: collections.Counter(g for t in texts for g in grams_of(t))}
    for k in range(n - 1, 0, -1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
    share, weight = {}, {}
    for c in levels.values():
        of = collections.Counter(c.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.0
        d = {j: max(0.0, j - (j + 1) * y * of[j + 1] / of[j]) if of[j] and of[1] else 0.5 for j in (1, 2, 3)}
        total, left = collections.Counter(), collections.Counter()
        for g, m in c.items():
            total[g[:-1]] += m
            left[g[:-1]] += d[min(m, 3)]
        share |= {g: (m - d[min(m, 3)]) / total[g[:-1]] for g, m in c.items()}
        weight |= {g: left[g] / total[g] for g in total}

    def logp(gram):
        p = 1 / size
        for k in range(1, n + 1):
            p = share.get(gram[n - k :], 0.0) + weight.get(gram[n - k : -1], 1.0) * p
        return math.log(max(p, 1e-9))

    return logp


def grams_of(text):
    """Each symbol, and the end, with what stands before it."""
    point = lambda c: max(ord(c), 1) if ord(c) < 1024 else 1024 + ord(c) % (quality.SYMBOLS - 1024)
    codes = [0] * (quality.ORDER - 1) + [point(c) for c in text] + [0]
    return [tuple(codes[k : k + quality.ORDER]) for k in range(len(codes) - quality.ORDER + 1)]


def test_quality(spark, monkeypatch):
    rng = random.Random(2)
    good = [(k, " ".join(rng.choices(["the", "house", "stands", "on", "a", "hill", "été", "日本", "😀"], k=20))) for k in range(120)]
    bad = [(1000 + k, "".join(rng.choices("XQ!%$#09", k=60))) for k in range(10)]
    rows = [*good, *bad, (2000, None), (2001, ""), (None, "the house"), (5, good[5][1]), (1003, good[6][1]), (2002, "the house " * 70_000)]
    labels = spark.createDataFrame([(d, 1, 0, "x") for d, _ in good] + [(1000, 0, 0, "x"), (3, 0, 0, "x"), (None, 1, 0, "x"), (None, None, 0, "x")], "doc_id long, quality int, toxic int, key string")
    got = collections.defaultdict(list)
    for r in quality.judge(docs_of(spark, rows), labels).collect():
        got[r.doc_id].append(r)
    back = {r.id for r in spark.range(200).where(F.pmod(F.xxhash64("id"), F.lit(quality.HELD_BACK)) == 0).collect()}
    logp = kneser_ney([t for d, t in rows if d is not None and d < 1000 and d not in back])
    want = lambda t: math.exp(-sum(map(logp, grams_of(t))) / len(grams_of(t)))
    for d, t in [*good, *bad]:
        assert want(t) in [pytest.approx(r.perplexity, rel=1e-6) for r in got[d]]
    assert not any(r.kept for d, _ in bad for r in got[d] if r.n_symbols == 61) and not got[2000][0].kept and not got[2001][0].kept
    assert sum(got[d][0].kept for d, _ in good) >= 110 and len(got[5]) == 2 and len(got[None]) == 1 and got[2002][0].n_symbols == 700_001
    kept = quality.good_documents(docs_of(spark, rows), labels)
    assert kept.columns == docs_of(spark, rows).columns and 1000 not in {r.doc_id for r in kept.collect()}
    # Of two texts of one id, the bad one goes.
    assert {r.text for r in kept.where("doc_id = 1003").collect()} == {good[6][1]}
    assert quality.judge(docs_of(spark, []), labels).count() == 0
    none = labels.where("false")
    assert quality.judge(docs_of(spark, rows), none).where("kept").count() == len(rows) - 2


def test_quality_of_several_languages(spark):
    """Each language with enough trusted texts has a model of its own; the others share one."""
    rng = random.Random(4)
    words = {"xx": ["aba", "bab", "abba"], "yy": ["kek", "eke", "kekke"], "zz": ["mim", "imi"]}
    rows = [(1000 * j + k, " ".join(rng.choices(words[lang], k=12)), lang) for j, lang in enumerate(words) for k in range(120 if lang != "zz" else 20)]
    docs = spark.createDataFrame([*rows, (5000, rows[0][1], "yy"), (5001, rows[0][1], "xx"), (5002, rows[-1][1], None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, 1) for d, _, _ in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert len(got) == docs.count()
    assert got[5000].perplexity > 10 * got[5001].perplexity and got[5001].perplexity == got[0].perplexity
    assert got[5002].perplexity == got[2019].perplexity and not got[5000].kept and got[5001].kept


# 5 --------------------------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 50_256), max_size=300), st.integers(0, 5))
def test_coder_round_trip(ids, repeat):
    x = np.array(ids * repeat + ids, np.uint32)
    assert tokenbin.decode(tokenbin.encode(x)).tolist() == x.tolist()


@pytest.mark.parametrize("n", [0, 1, tokenbin.BLOCK - 1, tokenbin.BLOCK, tokenbin.BLOCK + 1, 5 * tokenbin.BLOCK + 7])
def test_coder_blocks(n):
    rng = np.random.default_rng(n)
    for x in (rng.integers(0, 50_257, n), np.full(n, 7), np.arange(n) % 3, np.minimum(rng.geometric(0.05, n), 50_000)):
        x = x.astype(np.uint32)
        assert (tokenbin.decode(tokenbin.encode(x)) == x).all()


def test_damage_is_seen():
    x = np.random.default_rng(3).zipf(1.3, 5000).clip(0, 60_000).astype(np.uint32)
    one = tokenbin.encode(x, [None, 7], [4000, 1000])
    for k in range(-(-len(x) // tokenbin.BLOCK)):
        assert (tokenbin.decode_block(one, k) == x[k * tokenbin.BLOCK : (k + 1) * tokenbin.BLOCK]).all()
    held = tokenbin.Segment(one)
    assert held.doc_ids.to_pylist() == [None, 7] and held.sizes.tolist() == [4000, 1000]
    many = np.random.default_rng(4).permutation(300_000).astype(np.uint32)
    assert (tokenbin.decode(tokenbin.encode(many)) == many).all()
    data = bytearray(tokenbin.encode(np.arange(5000, dtype=np.uint32) % 100))
    data[len(data) // 2] ^= 1
    with pytest.raises(ValueError):
        tokenbin.decode(bytes(data))


def test_token_files(spark, enc, odd_rows):
    rows = [(d, t) for d, t in odd_rows if d is not None]
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenbin.round_trip(docs_of(spark, rows), tokenizer()).collect())
    start = 0
    for (d, t), r in zip(sorted(rows, key=lambda x: (x[0], x[1] or "")), got, strict=True):
        ids = ids_of(enc, t)
        assert r == (start, d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokenbin.round_trip(docs_of(spark, []), tokenizer()).count() == 0


# 6 --------------------------------------------------------------------------------------------


def brute_repeats(rows, length=200):
    seen = collections.Counter(b[i : i + length] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        yield d, len(b), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()


def test_repeats(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices("abc dé", k=700)) for _ in range(3)]
    rows = [(100, None), (101, ""), (102, "a" * 500), (103, "ab" * 180), (104, base[0][:200]), (105, base[0][:199])]
    for i in range(60):
        t = rng.choice(base)[rng.randint(0, 300) :][: rng.randint(0, 500)]
        if t and rng.random() < 0.5:
            k = rng.randrange(len(t))
            t = t[:k] + rng.choice("XYZ") + t[k + rng.randint(0, 1) :]
        if rng.random() < 0.3:
            t += rng.choice(base)[: rng.randint(150, 320)]
        rows.append((i, t))
    got = sorted(tuple(r)[:5] for r in remove_repeats(docs_of(spark, rows)).collect())
    assert got == sorted(brute_repeats(rows))
    assert remove_repeats(docs_of(spark, [])).count() == 0


# 7 --------------------------------------------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = {}
    for d, t in rows:
        sets[d] = shingles(t)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def test_near_duplicates(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, t) for i, t in enumerate([None, "", " \n", "a b", "A B", "a b c d e", "hello"])]
    base = [[rng.choice(words) for _ in range(rng.randint(30, 150))] for _ in range(5)]
    for i in range(10, 420):
        b = list(rng.choice(base[:1] if i % 2 else base))  # one group is far larger than a small node
        for _ in range(rng.randint(0, 6)):
            b[rng.randrange(len(b))] = rng.choice(words)
        rows.append((i, " ".join(b).title() if i % 5 == 0 else "\n".join(b)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_groups(docs_of(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_outside_a_crowd(spark):
    """Groups of 200 long texts that differ in their last word, each with one text of similarity 0.77 to all of them."""
    rows, want = [], {}
    for g in (7, 15, 26, 30):
        rng, first = random.Random(g), 1000 * g
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(2000)]
        rows += [(first + k, " ".join([*base, f"end{k}"])) for k in range(200)]
        far = list(base)
        for at in rng.sample(range(10, 1990, 10), 53):
            far[at] = "changed"
        rows.append((first + 900, " ".join(far)))
        want |= {d: first for d in [*range(first, first + 200), first + 900]}
    assert {r.doc_id: r.component_id for r in near_groups(docs_of(spark, rows)).collect()} == want


def rows_joined(spark, on, run):
    """Rows that joins on these keys make while this runs, and what it returns."""
    store = spark._jsparkSession.sharedState().statusStore()
    ids = lambda: {listed.apply(k).executionId() for listed in [store.executionsList()] for k in range(listed.size())}
    before, made = ids(), 0
    out = run()
    for at in ids() - before:
        nodes, values = store.planGraph(at).allNodes(), store.executionMetrics(at)
        for node in (nodes.apply(i) for i in range(nodes.size())):
            metrics = node.metrics()
            for metric in (metrics.apply(i) for i in range(metrics.size())) if "Join" in node.name() and on in re.sub(r"#\d+L?", "", node.desc()) else ():
                if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                    made += int(values.apply(metric.accumulatorId()).replace(",", ""))
    return made, out


def test_near_duplicates_in_a_crowd_meet_few_joins(spark):
    """600 near copies of which every fifth is linked with few or none: sizes and sketches are not asked for at each level, nor components for each use."""
    rng = random.Random(11)
    base, rows = [f"w{rng.randrange(10**6)}" for _ in range(150)], []
    for d in range(600):
        b = list(base)
        for at in rng.sample(range(0, 150, 6), rng.randint(6, 8) if d % 5 == 0 else rng.randint(0, 2)):
            b[at] = f"c{rng.randrange(10**6)}"
        rows.append((d, " ".join(b)))
    made, got = rows_joined(spark, "[rep], [rep], Inner", lambda: near_groups(docs_of(spark, rows)).collect())
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want and len({c for _, c, _ in want.values()}) > 20
    assert made < 60 * len(rows)


def test_near_duplicate_edges(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")]
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in near_groups(docs_of(spark, rows)).collect())
    assert got == [(-1, None, True), (2, 2, True), (2, 2, True), (4, 2, False)]
    assert sorted((r.doc_id or -1) for r in one_of_each(docs_of(spark, rows)).collect()) == [-1, 2, 2]
    assert near_groups(docs_of(spark, [])).count() == 0


def test_near_duplicates_that_share_an_id(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = [(2, b), (3, b), (2, a), (5, a + " more"), (9, "x y")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_groups(docs_of(spark, rows)).collect())
    assert got == [(2, 36, 2, True), (2, 36, 2, True), (3, 36, 2, False), (5, 37, 2, False), (9, 1, 9, True)]
    # The two texts of id 2 are apart, so both stay.
    assert {(r.doc_id, r.text) for r in one_of_each(docs_of(spark, rows)).collect()} == {(2, a), (2, b), (9, "x y")}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {v: find(v) for a, b in edges if a != b for v in (a, b)}
    assert got == want


# 8 --------------------------------------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(6)
    plain = ["the", "river", "runs", "down", "to", "sea", "and", "you", "see", "it"]
    rude = ["zorgblat", "frimpish", "zorgbling"]
    rows, labels = [], []
    for d in range(400):
        w = rng.choices(plain, k=rng.randint(5, 60))
        bad = d % 5 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(rude))
        rows.append((d, " ".join(w)))
        labels.append((d, 1, int(bad), 0.5))
    rows += [(1000, None), (1001, ""), (None, "you")]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score double")
    docs = docs_of(spark, rows)
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, table)).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in range(400)}
    assert all(got[d].held_out == held[d] for d in held) and got[None].held_out
    test = [d for d in held if held[d]]
    assert sum(got[d].predicted == int(d % 5 == 0) for d in test) >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert len({got[1000].score, got[1001].score}) == 1
    assert toxicity.score(docs_of(spark, []), toxicity.fit(docs, table)).count() == 0
    none = toxicity.score(docs, toxicity.fit(docs, table.where("false"))).collect()
    assert {r.score for r in none} == {0.5}


def test_labels_are_no_input(spark):
    rows = [(d, "same words every time") for d in range(30)]
    docs = docs_of(spark, rows)
    table = spark.createDataFrame([(d, 1, d % 2) for d in range(30)], "doc_id long, quality int, toxic int")
    assert len({r.score for r in toxicity.score(docs, toxicity.fit(docs, table)).collect()}) == 1


# 9 --------------------------------------------------------------------------------------------


def test_licenses(spark):
    rows = [
        (1, None), (2, ""), (3, "MIT"), (4, "The MIT  License, the mit-license"), (5, "See the GNU General Public License. Apache License"),
        (6, "x Licensed under CC BY-NC 4.0. y"), (7, "Licensed under CC extra BY-NC 4.0"), (8, "This work is licensed under the GNU General Public License, version 3."), (8, "plain"), (None, "Apache License"), (9, "license"),
    ]
    got = collections.defaultdict(list)
    for r in scan(docs_of(spark, rows)).collect():
        got[r.doc_id].append(r)
    one = lambda d: got[d][0]
    assert (one(1).n_words, one(1).n_base, one(1).first_word, one(1).labels, one(1).score) == (0, 0, None, "", 0.0)
    assert (one(4).n_base, one(4).first_word, one(4).last_word, one(4).base_labels) == (2, 1, 4, "mit")
    assert one(5).base_labels == "apache,gpl" and one(5).first_word == 3 and one(5).last_word == 6
    assert one(6).labels == "cc-by-nc" and one(6).score == 1.0 and one(6).n_base == 0
    assert {r.labels for r in got[8]} == {"gpl", ""} and one(None).labels == "apache" and one(9).n_base == 0
    assert scan(docs_of(spark, [])).count() == 0


def test_licenses_are_verified(spark):
    """Repeated words vote once, and votes that lie far apart are no span."""
    own = (("x", "red red red red blue green"), ("y", "one two three four five six seven eight"))
    far = " ".join(f"one two three filler{k} " * 2 for k in range(9))
    rows = [(1, "red red red red red red red red"), (2, "red red red red blue green"), (3, far + "four five six seven"), (4, "one two three oops four five six seven eight"), (5, "red red red red blue " * 40 + "green")]
    got = {r.doc_id: (r.labels, r.score) for r in scan(docs_of(spark, rows), own).collect()}
    assert got[1] == ("", 0.0) and got[2] == ("x", 1.0) and got[3][0] == "" and got[4] == ("", 0.0) and got[5][0] == "x"


# 10 -------------------------------------------------------------------------------------------


def test_exact_groups(spark, odd_rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_groups(docs_of(spark, odd_rows)).collect())
    groups = collections.defaultdict(list)
    for d, t in odd_rows:
        groups[(t or "").translate(LOWER)].append(d)
    assert len(got) == len(odd_rows)
    for _, d, keep, n, _, sha in got:
        body = next(b for b in groups if hashlib.sha256(b.encode()).hexdigest() == sha)
        assert n == len(groups[body]) and keep == max((x for x in groups[body] if x is not None), default=None) and (d in groups[body] or d == 0)
    assert sum(r[4] for r in got) == len(groups)
    assert exact_groups(docs_of(spark, [])).count() == 0


def test_distinct_documents(spark, odd_rows):
    out = distinct_documents(docs_of(spark, odd_rows))
    assert out.columns == docs_of(spark, odd_rows).columns
    assert out.count() == len({(t or "").translate(LOWER) for _, t in odd_rows})


def test_distinct_documents_with_clashing_names(spark):
    rows = [(1, "A b", "K1", "s1", "e"), (1, "a B", "K2", "s2", "f"), (2, "c", "K3", "s3", "g"), (None, None, "K4", "s4", "h"), (None, "", "K5", "s5", "i")]
    out = distinct_documents(spark.createDataFrame(rows, "doc_id long, text string, _id string, _sha string, stays_sha string")).collect()
    assert len(out) == 3 and all(tuple(r) in rows for r in out)
    again = distinct_documents(spark.createDataFrame(rows[::-1], "doc_id long, text string, _id string, _sha string, stays_sha string")).collect()
    assert {r._id for r in out} == {r._id for r in again}


def test_directory_doubles_where_it_must():
    counts = {0: 10_000, 1: 5, 40_000: 3}
    bucket = directory(counts, capacity=100)
    assert bucket[0] != bucket[1] and bucket[40_000] == bucket[50_000] and len(set(bucket.tolist())) > 10
    assert len(set(directory({}, capacity=100).tolist())) == 1
