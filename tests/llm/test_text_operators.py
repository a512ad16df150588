"""Text operators against brute force, and their edge cases."""

import base64
import hashlib
import random
import re

import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retail_pulse.llm import bpe, decontam, langid, simhash, substring, tokencount, toxicity

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, fp long, spans string, doc string, sig string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def odd_rows():
    """NULLs in any column, empty and long texts, ties, repeated rows, columns that clash with inner names."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(30, 80))) for _ in range(12)]
    texts = [None, "", " \t\n ", "x", "a b", "Aa AA aA", "!!! ??? 123", "word " * 50, "word " * 50, base[0], base[0],
             base[0] + " " + base[1], base[1] + "\n" + base[0], base[2].replace(" ", "\x0b", 3), base[2], " ".join(base) * 30,
             "<|endoftext|> hi<|endoftext|>", "  two  spaces nbsp \x1c\x85 日本語 ½ 👩‍👩‍👧", "aaaa" * 40]
    rows = [(i, t, "en" if i % 3 else None, i, "s", "d", "g") for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, base[3], None, None, None, None, None), (None, base[3], "en", 1, "", "", ""), (None, None, None, None, None, None, None),
             (9, base[4], "de", 0, "", "", ""), (1000, base[5], "de", 0, "", "", "")]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- SimHash ----

def simple_fingerprint(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simple_classes(rows):
    """(id, fingerprint, least id) of every row, by comparing all pairs."""
    fps = [simple_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        out.append((doc, f"{fps[i]:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def test_simhash_against_all_pairs(odd, odd_rows, none):
    got = simhash.near_duplicates(odd).collect()
    assert sorted(map(tuple, got), key=repr) == simple_classes([r[:2] for r in odd_rows])
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_links_of_close_fingerprints(spark):
    rng = random.Random(3)
    fps = {0, 2**64 - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(4):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 4)):
                y ^= 1 << b
            fps.add(y)
    signed = {x: x - 2**64 if x >= 2**63 else x for x in fps}
    want = {tuple(sorted((signed[a], signed[b]))) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3}
    got = simhash.links(spark.createDataFrame([(x,) for x in signed.values()], "fp long"))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 50


def joins(df):
    """The joins of the plan, before anything runs."""
    return re.findall(r"\w+Join\w*", df._jdf.queryExecution().executedPlan().toString())


def test_links_are_not_broadcast_by_the_size_of_the_file_they_come_from(spark, tmp_path):
    """Each fingerprint is stored under 68 keys: a file below the limit of a broadcast holds far more than the driver takes."""
    spark.range(1000).selectExpr("xxhash64(id) AS fp", "struct(id IS NULL AS none, id, id AS sig) AS least").write.parquet(str(tmp_path / "d"))
    distinct = spark.read.parquet(str(tmp_path / "d"))
    assert joins(simhash.links(distinct)) == ["SortMergeJoin"]
    found = joins(simhash._classes(distinct, 3))
    assert found and set(found) == {"SortMergeJoin"}


def test_near_duplicates_broadcast_no_table_of_all_rows(spark):
    """Rows are never sent through the driver because their file of ids and fingerprints is small."""
    text = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(i, text + " x" * (i % 7)) for i in range(300)] + [(None, text), (9, None)], "doc_id long, text string")
    out = simhash.near_duplicates(docs)
    assert joins(out)[0] == "SortMergeJoin"  # the last one, of all rows with their classes
    assert sorted(map(tuple, out.collect()), key=repr) == simple_classes([(r.doc_id, r.text) for r in docs.collect()])


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = dict(map(tuple, simhash.components(edges).collect()))
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


# ---- repeats ----

def simple_repeats(rows, n):
    """Kept words of every row; rows of one id and text are one document, ids are ordered with NULL last, then by a hash."""
    def key(r):
        return (r[0] is None, r[0] or 0, xx(r[1]))

    def xx(t):
        h = xxhash.xxh64_intdigest((t or "").encode(), 42)
        return h - 2**64 if h >= 2**63 else h

    seen, kept = set(), {}
    for r in sorted({(d, t) for d, t in rows}, key=key):
        w = words(r[1])
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            k = tuple(w[s:s + n])
            if k in seen:
                gone[s:s + n] = [True] * n
            seen.add(k)
        kept[r] = [x for x, g in zip(w, gone, strict=True) if not g]
    return kept


@pytest.mark.parametrize("window, options", [(20, {}), (5, {"anchor": 2, "block_words": 200}), (6, {"anchor": 3, "group_rows": 1, "max_hot": 10**9}),
                                             (20, {"filter_bits": 6, "block_words": 100})])
def test_repeats_against_brute_force(odd, odd_rows, window, options):
    rows = [r[:2] for r in odd_rows]
    # rows of one id and different texts and NULL texts: both read as empty by the operator
    kept = simple_repeats([(d, t or "") for d, t in rows], window)
    want = sorted(((d, len(words(t)), len(words(t)) - len(kept[d, t or ""]), hashlib.sha256(" ".join(kept[d, t or ""]).encode()).hexdigest()) for d, t in rows), key=repr)
    assert sorted(map(tuple, substring.remove_repeats(odd, window=window, **options).collect()), key=repr) == want


def test_removed_spans_are_not_broadcast_by_the_size_of_their_file(spark):
    """The lists of spans are packed in the file; in memory they take many times that."""
    text = " ".join(map(str, range(60)))
    docs = spark.createDataFrame([(i, text) for i in range(5)] + [(None, text), (9, None)], "doc_id long, text string")
    out = substring.cut_repeats(docs)
    assert joins(out) == ["SortMergeJoin"]
    assert {(r.doc_id, r.text) for r in out.collect()} == {(0, text)}


def test_removals_within_a_task_are_dealt_over_many_groups(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    rng = random.Random(13)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(60))
    df = spark.createDataFrame([(i, text) for i in range(200)], "doc_id long, text string").coalesce(1)
    dealt, plain = [], DataFrame.repartition

    def spy(self, *by):
        dealt.extend([self] if by == ("gram",) else [])
        return plain(self, *by)

    monkeypatch.setattr(DataFrame, "repartition", spy)
    assert sorted(r.n_removed for r in substring.remove_repeats(df, window=20).collect()) == [0] + [60] * 199
    rows = dealt[0].filter("words IS NULL").agg(F.count("*").alias("n"), F.count_distinct("gram").alias("groups")).first()
    assert rows.n >= 199 and rows.groups > 100


def test_equal_rows_find_their_spans_once(spark):
    words = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, words)] + [(2, words)] * 1500 + [(None, words)] * 50, "doc_id long, text string").repartition(8)
    spans = {r.doc: len(r.spans) for r in substring.removed_windows(df, "doc_id", "text", 20).collect()}
    assert max(spans.values()) < 100  # not one for each row
    got = {(r.doc_id, r.n_removed) for r in substring.remove_repeats(df, window=20).collect()}
    assert got == {(1, 0), (2, 40), (None, 40)}


def test_cut_repeats_keeps_untouched_texts_and_all_columns(spark, none):
    a = " ".join(f"w{i}" for i in range(30))
    rows = [(1, "p  q\n" + a, 5), (2, "x y " + a + " z", 0), (3, a, 1), (4, None, 2), (5, "short  text", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("sig", F.lit("mine"))
    got = {r.doc_id: r for r in substring.cut_repeats(df).collect()}
    assert {k: r.text for k, r in got.items()} == {1: rows[0][1], 2: "x y z", 5: "short  text"}
    assert got[2].n_chars == 5 and got[2].sig == "mine"
    assert substring.cut_repeats(none).columns == none.columns and substring.remove_repeats(none).count() == 0


# ---- tokens ----

@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_round_trips(odd, odd_rows, none, library):
    got = sorted(map(tuple, bpe.round_trip(odd, RANKS, P.PATTERN).collect()), key=repr)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for d, t in (r[:2] for r in odd_rows):
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=repr)
    both = bpe.decode(bpe.encode(odd, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert both.columns == [*odd.columns, "token_ids", "decoded"]
    assert all(bytes(r.decoded).decode() == (r.text or "") and r.token_ids == library.encode_ordinary(r.text or "") for r in both.collect())
    assert bpe.round_trip(none, RANKS, P.PATTERN).count() == 0


def test_merge_replay_of_random_bytes(library):
    rng = random.Random(1)
    pieces = list({bytes(rng.choice(b"abet hinrs\xc3\xa9") for _ in range(rng.randint(1, 40))) for _ in range(3000)} | {b"a" * n for n in range(1, 70)})
    got = bpe.MergeReplay(RANKS, P.PATTERN).replay(pieces)
    assert all(list(ids) == library._encode_single_piece(p) for p, ids in zip(pieces, got, strict=True))


@pytest.mark.parametrize("places, hot_share", [(None, 0.02), (3, 0.0)])
def test_token_counts_equal_the_library(odd, odd_rows, none, places, hot_share):
    tok = Tokenizer.from_file(JSON)
    want = []
    for d, t in (r[:2] for r in odd_rows):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 512))
    got = tokencount.count_tokens(odd, JSON, P.PATTERN, places=places, hot_share=hot_share).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert tokencount.count_tokens(none, JSON, P.PATTERN).count() == 0


# ---- language ----

def test_language_of_held_out_texts(spark, none):
    rng = random.Random(2)
    sounds = {"aa": ["ba", "lo", "mi", "tu"], "bb": ["schr", "ng", "ei", "tz"], "cc": ["ña", "ció", "rra", "que"]}
    text = lambda k, n: " ".join("".join(rng.choice(sounds[k]) for _ in range(3)) for _ in range(n))
    rows = [(i, text(k, 40), k) for i, k in enumerate(["aa", "bb", "cc"] * 20)] + [(900, None, "aa"), (901, text("aa", 5), None), (902, "12 !!", "bb")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = [(i, text(k, 12), k) for i, k in enumerate(["aa", "bb", "cc"] * 5)] + [(90, None, langid.UND), (91, "", langid.UND), (92, "12 !?", langid.UND), (93, "q", None),
                                                                                 (94, text("bb", 12) * 2000, "bb")]
    df = spark.createDataFrame(asked, "doc_id long, text string, score string").repartition(2)
    got = {r.doc_id: r for r in langid.classify(df, model).collect()}
    assert [(i, got[i].lang_pred, k) for i, _, k in asked if k and got[i].lang_pred != k] == []
    assert got[93].lang_pred in sounds and all(0 <= r.score <= 1 for r in got.values()) and got[90].score == 0
    assert langid.classify(none, model).count() == 0
    empty = langid.train(none)
    assert {r.lang_pred for r in langid.classify(df, empty).collect()} == {langid.UND}


def test_language_masks_beyond_one_word(spark):
    alphabet = [chr(0x4E00 + i) for i in range(70 * 3)]
    rows = [(f"l{i:02}", " ".join(["".join(alphabet[3 * i:3 * i + 3])] * 4)) for i in range(70)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert all(r.lang == r.lang_pred for r in langid.classify(df, langid.train(df)).collect())


# ---- toxicity ----

def test_toxic_words_are_learned_and_clean_texts_left_alone(spark, none):
    rng = random.Random(4)
    vocab = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randint(1, 4))) for _ in range(800)]
    bad = ["zorgblat", "quixnoid", "vrempus", "klatchow"]

    def text(toxic):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        for _ in range(rng.randint(3, 6) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        return " ".join(w)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (None, "re he in")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i, _, k in rows if i < 600] + [(None, 1), (7, None), (99999, 1), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(got[i].predicted, k) for i, _, k in rows if i >= 600]
    assert sum(p for p, k in held if k) >= 0.9 * sum(k for _, k in held)
    assert sum(p for p, k in held if not k) <= 0.05 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values()) and got[5000].score == got[5001].score and got[5000].predicted == 0
    assert toxicity.score(none, model).count() == 0


def test_toxicity_without_labels_of_both_kinds(spark, odd):
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    got = toxicity.score(odd, toxicity.fit(odd, labels)).collect()
    assert len(got) == odd.count() and {r.score for r in got} == {0.0}


# ---- contamination ----

def test_contamination_verbatim_paraphrased_and_clean(spark, none):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    common = ["the", "of", "and", "to", "in"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]
    items = [text(rng.randint(15, 50)) for _ in range(30)]
    docs, want = [], set()
    for i in range(150):
        w = text(rng.randint(40, 300))
        if i % 5 == 0:
            item = list(items[i // 5])
            if i % 10 == 0:  # a paraphrase: one word in eight is another, the answer stays
                for k in range(0, len(item) - max(3, len(item) // 4), 8):
                    item[k] = rng.choice(vocab)
            at = rng.randrange(len(w))
            w[at:at] = item
            want.add((i, i // 5))
        docs.append((i, ("  " if i % 2 else "\n").join(w).replace("the", "The,")))
    long = text(3000)
    long[2500:2500] = items[3]
    docs += [(500, " ".join(long)), (501, None), (502, ""), (None, " ".join(items[4])), (503, docs[0][1]), (503, docs[0][1])]
    want |= {(500, 3), (None, 4), (503, 0)}
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)] + [(90, None), (91, ""), (92, "!!")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")).repartition(3)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert got == want
    blocks = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench, item_block=8).collect()}
    assert blocks == want
    assert decontam.contaminated(none, bench).count() == 0 and decontam.contaminated(df, bench.limit(0)).count() == 0


def test_contamination_by_items_of_all_lengths(spark):
    rng = random.Random(16)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 8))) for _ in range(4000)]
    usual = vocab[:150]  # words of every document
    filler = lambda n: [rng.choice(usual) for _ in range(n)]
    rare = lambda n: ["x" + rng.choice(vocab) for _ in range(n)]
    items = [rare(1), rare(2), rare(2) * 3, rare(5), rare(200), rare(500), filler(200), filler(500), rare(30), rare(1200)]
    # rare words spread over a long item of usual ones
    items += [[w if k % 25 else "y" + rng.choice(vocab) for k, w in enumerate(filler(300))]]
    docs = [(i, filler(300)) for i in range(40)]
    for i, item in enumerate(items):
        w, at = filler(260), rng.randrange(260)
        docs.append((100 + i, w[:at] + item + w[at:]))
    docs += [(200, items[1]), (201, items[0]), (202, [x for k in range(60) for x in items[8][k % 30:k % 30 + 1] * (k < 30)] + items[3] + rare(40))]
    want = {(100 + i, i) for i in range(len(items))} | {(200, 1), (201, 0), (202, 8), (202, 3)}
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string").repartition(3)
    for options in ({}, {"item_block": 16}):
        assert {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench, **options).collect()} == want


def test_contamination_by_items_cut_at_either_end(spark):
    rng = random.Random(18)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 8))) for _ in range(4000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [text(n) for n in (16, 24, 40, 60, 200)]
    docs, want = [], set()
    for k, item in enumerate(items):
        for j, share in enumerate((0.75, 0.85)):
            n = -(-int(len(item) * share * 100) // 100) + 1
            for at, part in enumerate((item[:n], item[-n:])):
                w = text(120)
                w[50:50] = part
                docs.append((100 * k + 10 * j + at, w))
                want.add((100 * k + 10 * j + at, k))
        loose = [x if i % 3 else rng.choice(vocab) for i, x in enumerate(item[:-len(item) // 4])]
        docs.append((100 * k + 50, text(50) + loose + text(50)))  # a loose likeness without the answer
    # 65 % of a long item, word for word
    docs.append((900, text(50) + items[4][:130] + text(50)))
    want.add((900, 4))
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()} == want


def _simple_contamination(docs, items, min_lcs=0.6, dense_lcs=0.75, min_answer=0.5, exact_run=13):
    """Every item against every stretch of an item's length and a third of every document, without any candidate search."""
    import numpy as np
    words = lambda t: decontam._clean(t).split()
    found = set()
    for i, it in items:
        own = words(it)
        number = {w: k for k, w in enumerate(dict.fromkeys(own))}
        a = np.array([number[w] for w in own])
        answer = {number[w] for w in own[-max(3, len(own) // 4):]}
        width = len(own) + len(own) // 3 + 2
        for d, t in docs:
            place, b = [], []
            for p, w in enumerate(words(t)):
                if w in number:
                    place.append(p)
                    b.append(number[w])
            place, b = np.array(place), np.array(b)
            for s in range(len(b)):
                e = int(np.searchsorted(place, place[s] + width))
                if e - s < min_lcs * len(a):
                    continue
                share = decontam.lcs(a, b[s:e]) / len(a)
                if share >= min_lcs and (share >= dense_lcs or len(answer & set(b[s:e].tolist())) / len(answer) >= min_answer
                                         or decontam.longest_run(a, b[s:e], place[s:e]) >= exact_run):
                    found.add((d, i))
                    break
    return found


def test_candidates_against_all_pairs_of_documents_and_items(spark):
    """Recall of the latent search over whole tables, with paraphrases planted: nothing but what all pairs give, and nearly all of that."""
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rng = random.Random(5)
    pool = [w for _, t in docs[:50] for w in (t or "").split()]
    for n, (_, t) in enumerate(items * 2):  # words dropped, replaced and put in
        kept = [w if rng.random() > 0.12 else rng.choice(pool) for w in t.split() if rng.random() > 0.08]
        at = rng.randrange(len(kept))
        docs.append((100_000 + n, " ".join([*rng.choices(pool, k=60), *kept[:at], rng.choice(pool), *kept[at:], *rng.choices(pool, k=60)])))
    want = _simple_contamination(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got <= want and len(want) > len(items)
    assert len(got) >= 0.95 * len(want)


def test_latent_space_is_smaller_than_the_items_and_joins_words_that_occur_together(spark):
    """Two words that always stand among the same others are near each other in the latent space; in plain TF-IDF they share nothing."""
    import numpy as np
    rng = random.Random(2)
    topics = [[f"t{k}w{i}" for i in range(14)] for k in range(24)]
    items = [(k, " ".join(rng.sample(t, 10))) for k, t in enumerate(topics)] + [(100 + k, " ".join(rng.sample(t, 10))) for k, t in enumerate(topics)]
    docs = spark.createDataFrame([(n, " ".join(rng.sample(topics[n % 24], 9) + rng.sample(topics[n % 24], 9))) for n in range(600)], "doc_id long, text string").repartition(4)
    block = decontam._items([(i, t, None) for i, t in items], 24)
    hits = decontam.written(decontam._hits(docs, block, "doc_id", "text", 200, 3), "test-hits")
    df, total = decontam._statistics(hits, len(block.vocabulary), 24)
    idf = decontam._idf(block, df, total, 1.0, 8, 24)
    basis = decontam.latent_basis(hits, block, block.pieces, idf, 24, 3)
    assert basis.shape[1] < len(items)  # the items cannot all have a direction of their own
    plain = decontam._item_matrix(block, block.pieces, idf)
    latent = decontam._unit(plain @ basis)
    a, b = plain @ plain.T, latent @ latent.T
    own, other = np.arange(24), np.arange(24) + 24  # two items of one topic, in different words
    assert (b[own, other] > a[own, other] + 0.05).mean() > 0.9 and b[own, other].mean() > 0.8


def test_lcs_against_the_table():
    import numpy as np
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 70))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert decontam.lcs(np.array(a, dtype=int), np.array(b, dtype=int)) == row[-1]


def test_decontam_learns_from_every_passage(spark, monkeypatch):
    """The latent space is fitted on all documents, however many there are, and the table of products is A'A over all of them."""
    import numpy as np
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 12))) for i in range(4100)], "doc_id long, text string").repartition(3)
    items = [(i, " ".join(rng.choice(words, 20)), None) for i in range(6)]
    seen = []
    fit = decontam.latent_basis
    monkeypatch.setattr(decontam, "latent_basis", lambda rows, *args, **kw: seen.append(rows.count()) or fit(rows, *args, **kw))
    decontam.contaminated(docs, spark.createDataFrame([r[:2] for r in items], "item_id long, text string")).count()
    block = decontam._items(items, 24)
    hits = decontam.written(decontam._hits(docs, block, "doc_id", "text", 200, 3), "test-hits")
    assert seen == [hits.count()] and seen[0] > 4000

    monkeypatch.setattr(decontam, "_HELD_PAIRS", 500)  # several partial sums
    n_terms = len(block.vocabulary)
    idf = np.linspace(1, 2, n_terms)
    want = np.zeros((n_terms, n_terms))
    for r in hits.collect():
        pos, term = np.frombuffer(r.pos, dtype=np.int32), np.frombuffer(r.term, dtype=np.int32)
        cells = pos // 24
        for p in range(-1, int(cells[-1]) + 1):
            own, tf = np.unique(term[(cells == p) | (cells == p + 1)], return_counts=True)
            if len(own) >= 3:
                a = (1 + np.log(tf)) * idf[own]
                a /= np.linalg.norm(a)
                want[np.ix_(own, own)] += np.outer(a, a)
    got = decontam._gram_times(decontam.gram(hits, idf, 24, 3), np.eye(n_terms, dtype=np.float32))
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4)
