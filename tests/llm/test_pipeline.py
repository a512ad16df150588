"""The pipeline on a small corpus with planted cases, stage by stage and as a whole."""

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    """Rows of documents, the benchmark, and what must come of each document: its text, or None if it goes."""
    rng = random.Random(9)
    sounds = {"xx": ["ba", "lo", "mi", "tu", "ke", "ra"], "yy": ["schr", "ng", "ei", "tz", "pf", "au"]}

    def words(lang, n):
        return ["".join(rng.choice(sounds[lang]) for _ in range(rng.randint(2, 5))) for _ in range(n)]

    items = [words("xx", 30) for _ in range(4)]
    rows, want = [], {}

    def add(text, expected, lang="xx"):
        i = len(rows)
        rows.append((i, text, lang, f"s{i % 2}", len(text) if text is not None else None))
        want[i] = expected
        return i

    for k in range(60):  # clean documents with their own white space
        lang = "xx" if k % 2 else "yy"
        t = "\n".join(" ".join(words(lang, 20)) for _ in range(3))
        add(t, t, lang if k % 7 else None)
    base = words("xx", 400)
    t = " ".join(base)
    add(t, t)
    add(t, None)  # a copy
    add(t.upper(), None)  # and one that differs in case only
    near = list(base)
    near[200] = "anders"
    add(" ".join(near), None)  # a near copy
    passage = words("yy", 60)
    own = [words("yy", 50) for _ in range(3)]
    for k, o in enumerate(own):  # a passage of over 50 words that repeats across documents
        text = " ".join(o[:25] + passage + o[25:])
        add(text, text if not k else " ".join(o), "yy")
    for k, item in enumerate(items):  # benchmark passages
        o = words("xx", 80)
        add(" ".join(o[:40] + item + o[40:]), None)
    add(None, None)
    add("", None)
    add("12 !? 34", None)
    rows += [rows[3], (None, " ".join(words("xx", 40)), None, None, None)]
    want[None] = rows[-1][1]
    return rows, [(k, " ".join(t)) for k, t in enumerate(items)], want


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rows, items, want = corpus()
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, want


def test_pipeline_catches_what_is_planted_and_keeps_the_rest(spark, planted):
    d, want = planted
    got = corpus_pipeline.run(spark, d)
    assert got.columns == [*COLUMNS, "token_ids", "n_tokens"]
    got = got.collect()
    assert len(got) == len({r.doc_id for r in got})
    assert {r.doc_id: r.text for r in got} == {k: v for k, v in want.items() if v is not None}
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(r.token_ids == enc.encode_ordinary(r.text) and r.n_tokens == len(r.token_ids) for r in got)
    assert all(r.n_chars == len(r.text) for r in got if r.doc_id is not None)


def test_every_stage_keeps_columns_that_clash_and_takes_an_empty_table(spark, planted):
    d, _ = planted
    docs = spark.read.parquet(f"{d}/documents.parquet").filter("doc_id < 8 or doc_id is null")
    for c in ("spans", "lang_pred", "nth", "bad_id", "fp", "text_hash"):
        docs = docs.withColumn(c, F.lit("mine"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_dedup", "substring_dedup", "decontaminate", "bpe_encode"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        assert out.columns[:len(docs.columns)] == docs.columns and (k == 4 or out.columns == docs.columns)
        assert all(r.nth == r.fp == "mine" for r in out.collect())
        assert stage(spark, docs.limit(0), d).count() == 0


def test_language_stage_rejects_unlearned_languages_and_letter_noise(spark, planted):
    d, _ = planted
    rng = random.Random(5)
    pick = lambda parts, n: " ".join("".join(rng.choice(parts) for _ in range(rng.randint(2, 5))) for _ in range(n))
    docs = spark.read.parquet(f"{d}/documents.parquet")
    strange = [(1000, pick(["zwo", "iq", "vhy", "jux", "ofd"], 40)), (1001, pick(["съе", "шь", "же", "мяг"], 40)),
               (1002, pick("abcdefghijklmnopqrstuvwxyz", 80)), (1003, "qxzv" * 30), (None, pick(["zwo", "iq", "vhy", "jux", "ofd"], 40))]
    kept = [(2000, "zwoiq"), (2001, pick(["ba", "lo", "mi", "tu", "ke", "ra"], 30) + " zwo iq vhy"), (None, pick(["schr", "ng", "ei", "tz"], 30))]
    rows = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in strange + kept], docs.schema)
    out = {(r.doc_id, r.text) for r in corpus_pipeline.language_id(spark, docs.union(rows), d).collect()}
    assert out.isdisjoint(strange) and out.issuperset(kept)
    clean = {(r.doc_id, r.text) for r in docs.collect() if r.text and any(map(str.isalpha, r.text))}
    assert out == clean | set(kept)


def test_dedup_stage_keeps_one_row_of_each_class_whatever_its_id(spark, planted):
    d, _ = planted
    rng = random.Random(12)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300))
    a, b, c, e, f, g = (text() for _ in range(6))
    rows = [(None, a), (None, a), (None, a.upper()),  # copies without an id
            (None, b), (3, b), (2, b),  # the least id stays
            (5, c), (5, e), (6, e), (4, c),  # two texts under one id, each with a copy of its own
            (7, f), (7, f), (7, g)]
    docs = spark.createDataFrame([(i, t, "xx", f"s{k}", len(t)) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.simhash_dedup(spark, docs.repartition(3), d)
    got = sorted(((r.doc_id, r.text.lower()) for r in out.collect()), key=repr)
    assert got == sorted([(None, a), (2, b), (4, c), (5, e), (7, f), (7, g)], key=repr)


def test_decontamination_stage_learns_from_all_its_documents(spark, tmp_path, monkeypatch):
    """The stage's latent space is fitted on every document with words of the benchmark, also of more than a few thousand."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=12))) for i in range(4100)]
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([*rows, (9000, item)], "doc_id long, text string")
    spark.createDataFrame([(1, item), (2, " ".join(words[:30]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen = []
    fit = corpus_pipeline.decontam.latent_basis
    monkeypatch.setattr(corpus_pipeline.decontam, "latent_basis", lambda hits, *args, **kw: seen.append(hits.count()) or fit(hits, *args, **kw))
    kept = {r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()}
    assert len(seen) == 1 and seen[0] > 4000 and 9000 not in kept and len(kept) >= 4000


def test_decontamination_stage_counts_the_words_of_documents_that_hold_few_of_them(spark, tmp_path, monkeypatch):
    """A word's frequency comes from every document that has it, also from those with too few words of the benchmark to be searched."""
    item = [f"q{i}" for i in range(30)]
    rows = [(i, " ".join(["other"] * 3 + item[:1 + i % 4])) for i in range(200)] + [(None, "other q0"), (201, "other"), (202, None), (203, " ".join(item))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen = []
    weigh = corpus_pipeline.decontam._idf
    monkeypatch.setattr(corpus_pipeline.decontam, "_idf", lambda items, df, total, *args: seen.append((items, df, total)) or weigh(items, df, total, *args))
    kept = {r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()}
    assert kept == {r[0] for r in rows} - {203}
    (block, df, total), = seen
    of_place = [int(df[t]) for t in block.terms[0][:5]]
    # the item's own 30 words are two cells, the first of which holds these
    assert of_place == [202, 151, 101, 51, 1] and total == 203
