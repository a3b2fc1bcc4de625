"""Each operator against brute force, a round trip or held-out accuracy, and on odd rows."""

import gzip
import hashlib
import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tillflow.llm import (bin_packing, chat_parts, line_crf, line_dedup, near_dups, order_minhash,
                          topk_nra, toxicity_fm, warc, word_bpe)
from tillflow.llm.labelled import remainder
from tillflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \n ", "a", "long line of text\nlong line of text\nx", "long line of text",
       "LONG LINE OF TEXT \n\n", "word " * 3000, "é" * 50 + "\n" + "É" * 50, "word " * 3000]


# 1

def brute_lines(texts):
    owner = {}
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})
    split = [(t or "").split("\n") for t in texts]
    for k, lines in enumerate(split):
        for line in lines:
            owner.setdefault(key(line), k)
    return [[x for x in lines if len(key(x)) < 10 or owner[key(x)] == k]
            for k, lines in enumerate(split)]


def test_line_dedup(docs_of):
    rows = line_dedup.dedup_lines(docs_of(ODD), batches=3).orderBy("doc_id").collect()
    expected = brute_lines(ODD)
    assert [r.kept_text for r in rows] == ["\n".join(x) for x in expected]
    assert [r.n_dropped for r in rows] == [len((t or "").split("\n")) - len(x)
                                           for t, x in zip(ODD, expected)]
    assert rows[0].pos == "x"


def test_line_dedup_repeats_nulls_and_nothing(spark, docs_of):
    rows = [(1, "the same long line"), (1, "the same long line"), (None, "the same long line")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.dedup_lines(docs, batches=2).collect()
    assert sorted((r.doc_id or 9, r.n_dropped) for r in found) == [(1, 0), (1, 0), (9, 1)]
    assert line_dedup.cleaned(docs_of([])).count() == 0


# 2

def test_archive_round_trip(spark):
    rows = [(1, "u", "same"), (2, None, "same"), (3, "a\r\nb", None), (4, "u", ""),
            (None, "u", "same"), (5, "u", "ü" * 200_000), (2, None, "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc.archive_pages(spark, pages).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes)
                  for r in found) == [
        (0, "revisit", 2, 4), (1, "revisit", 2, 4), (2, "response", 0, 4), (2, "response", 0, 4),
        (3, "revisit", 4, 0), (4, "response", 0, 0), (5, "response", 0, 400_000)]
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


@given(st.lists(st.binary(max_size=200), min_size=1, max_size=8))
@settings(max_examples=30, deadline=None)
def test_normaliser_keeps_every_byte(bodies):
    def record(body):
        fields = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>")]
        return warc.record_head(fields, len(body)) + body + b"\r\n\r\n"

    class Out(io.BytesIO):
        pass

    whole, out = b"".join(map(record, bodies)), Out()
    entries = list(warc.normalise_stream(io.BytesIO(gzip.compress(whole)), out))
    parts = [gzip.decompress(out.getvalue()[a:a + n]) for a, n, _, _ in entries]
    assert parts == [record(b) for b in bodies]


# 3 and 10

def labelled(spark, texts, column):
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(texts)],
                                   f"doc_id long, {column} int")
    return docs, labels


def test_quality_marks_held_out_junk(spark):
    rng = np.random.default_rng(1)
    words = ["then", "house", "river", "stone", "small", "green", "walked", "along"]

    def text(good):
        lines = [" ".join(rng.choice(words, 9)).capitalize() + "." for _ in range(4)]
        return "\n".join(lines if good else [x.upper().replace(" ", "!! ") for x in lines])

    docs, labels = labelled(spark, [(text(k % 3), int(k % 3 > 0)) for k in range(150)], "quality")
    fold = remainder("doc_id", 5)
    model = line_crf.fit(docs, labels, fold != 0)
    found = line_crf.score_texts(docs, model).where(fold == 0).join(labels, "doc_id").collect()
    assert found and all((r.score >= 0.3) == (r.quality == 1) for r in found)
    odd = spark.createDataFrame([(k, t, 0.0) for k, t in enumerate(ODD)],
                                "doc_id long, text string, score double")
    assert all(0 <= r.score <= 1 for r in line_crf.score_texts(odd, model).collect())
    assert line_crf.fit(docs, labels.where("quality = 1"), fold != 0) is None
    assert {r.score for r in line_crf.score_texts(odd, None).collect()} == {0.5}


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(2)
    odds, transitions, lines = rng.normal(size=5), rng.normal(size=(2, 2)), np.array([2, 3])
    good, _, partition = line_crf.marginals(odds, lines, transitions)
    expected, at, total = [], 0, 0.0
    for n in lines:
        weights = {}
        for code in range(2 ** n):
            y = [code >> k & 1 for k in range(n)]
            weights[tuple(y)] = np.exp(sum(odds[at + k] * y[k] for k in range(n)) + sum(
                transitions[a, b] for a, b in zip(y, y[1:])))
        z = sum(weights.values())
        total += np.log(z)
        expected += [sum(w for y, w in weights.items() if y[k]) / z for k in range(n)]
        at += n
    assert np.allclose(good, expected) and np.isclose(partition, total)


def test_toxicity_learns_pairs(spark):
    texts = []
    for k in range(240):
        insult, group = k % 2, k // 2 % 2
        texts.append((f"w{k % 7} {'fool' if insult else 'friend'} {'they' if group else 'it'}",
                      int(insult and group)))
    docs, labels = labelled(spark, texts, "toxic")
    fold = remainder("doc_id", 3)
    corpus_pipeline.shared_folder(spark)
    model = toxicity_fm.fit(docs, labels, fold != 1)
    found = toxicity_fm.score_texts(docs, model).where(fold == 1).join(labels, "doc_id").collect()
    assert found and all((r.score >= 0.7) == (r.toxic == 1) for r in found)
    assert toxicity_fm.fit(docs, labels.where("toxic = 0"), fold != 1) is None
    assert toxicity_fm.score_texts(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("name,column", [("op3_line_crf", "quality"), ("op10_toxicity_fm", "toxic")])
def test_held_out_accuracy(spark, name, column):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(F.col(column).isNotNull())
    rows = QUERIES[name](spark, folder).where("held_out").join(labels, "doc_id")
    right = rows.agg(F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0]
    assert right > 0.95


# 4

@given(st.lists(st.text(alphabet=st.sampled_from("aábcS'tls 1２\n漢ΣÉ!?.<|>\u0301\U0001F600ßſ")),
                max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_library(texts):
    tokenizer, own = Tokenizer.from_file(PATH), word_bpe.load(PATH)
    texts = texts + ["aaaaaaa !!!!!!!!!", "x<|endoftext|>Y'll", "\x1c\x85"]
    ids = own.encode_batch(texts)
    found = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in ids] == [f.ids for f in found]
    assert own.decode_batch(ids) == [tokenizer.decode(f.ids, skip_special_tokens=False)
                                     for f in found]


def test_long_texts_go_in_steps(docs_of, monkeypatch):
    monkeypatch.setattr(word_bpe, "STEP", 100)
    bpe = word_bpe.WordBpe(PATH)
    expected = Tokenizer.from_file(PATH).encode("word " * 3000, add_special_tokens=False).ids
    assert bpe.encode_batch(["word " * 3000])[0].tolist() == expected
    rows = word_bpe.code_texts(docs_of(ODD), PATH, decode=True).orderBy("doc_id").collect()
    assert rows[0].ids == [] and rows[0].decoded == "" and rows[3].pos == "x"


# 5

def brute_components(texts, percent):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    part = list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a] | sets[b])):
                old, new = max(part[a], part[b]), min(part[a], part[b])
                part = [new if p == old else p for p in part]
    return part


def test_near_duplicates(docs_of):
    rng = np.random.default_rng(3)
    texts = list(ODD)
    for group in range(6):
        base = [f"w{x}" for x in rng.integers(0, 500, 40 + 30 * group)]
        for _ in range(12):
            copy = list(base)
            for k in rng.integers(0, len(copy), rng.integers(0, 4)):
                copy[k] = f"e{rng.integers(0, 99)}"
            texts.append(" ".join(copy))
    rows = near_dups.near_duplicates(docs_of(texts), 80).orderBy("doc_id").collect()
    assert [r.component_id for r in rows] == brute_components(texts, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert near_dups.near_duplicates(docs_of([])).count() == 0


def test_rows_with_one_id_are_told_apart(spark):
    rng = np.random.default_rng(8)
    t, y, z = (" ".join(f"w{x}" for x in rng.integers(0, 500, 60)) for _ in range(3))
    rows = [(3, t), (5, t), (5, y), (5, z), (4, z), (6, y), (7, ""), (7, ""), (None, t), (None, t),
            (8, "x y"), (8, "x y")]
    docs = spark.createDataFrame([(k, x, n) for n, (k, x) in enumerate(rows)],
                                 "doc_id long, text string, pos long").repartition(3)
    kept = corpus_pipeline.dedup_documents(spark, docs, "").collect()
    # The empty texts have no set, so they stay; T of the rows without an id, too.
    expected = [(3, t), (5, y), (4, z), (7, ""), (7, ""), (None, t), (None, t), (8, "x y")]
    assert sorted(map(str, [(r.doc_id, r.text) for r in kept])) == sorted(map(str, expected))
    assert all(rows[r.pos] == (r.doc_id, r.text) for r in kept)
    found = near_dups.near_duplicates(docs).where("doc_id = 5").collect()
    assert sorted((r.component_id, r.kept) for r in found) == [(3, False), (4, False), (5, True)]


# 6

def test_parts_become_placeholders(spark):
    rows = spark.sql("""SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, array(
        named_struct('kind','text','text','see [image:0:9] \\\\ <s>','ref',null,'width',0,'height',0,'seconds',0d,'pages',0),
        named_struct('kind','image','text',null,'ref','a.png','width',28,'height',30,'seconds',0d,'pages',0),
        named_struct('kind','audio','text',null,'ref','b.wav','width',0,'height',0,'seconds',1.5d,'pages',0)) AS parts
        UNION ALL SELECT 1L, 1L, null, null""")
    first, second = chat_parts.format_turns(rows).orderBy("turn").collect()
    turns = list(chat_parts.TurnParser().feed(first.formatted + second.formatted))
    assert [role for role, _ in turns] == ["user", ""] and turns[1][1] == ""
    assert chat_parts.body_parts(turns[0][1]) == [
        ("text", "see [image:0:9] \\ <s>"), ("image", 1, 6), ("audio", 2, 38)]
    assert [(a.ref, a.tokens) for a in first.attachments] == [("a.png", 6), ("b.wav", 38)]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "x]"]),
                          st.text(alphabet="<s>/[]INST\\lb \n", max_size=20)), max_size=5))
@settings(max_examples=15, deadline=None)
def test_any_text_comes_back(spark, turns):
    rows = spark.createDataFrame([(7, k, r, t) for k, (r, t) in enumerate(turns)],
                                 "conv_id long, turn long, role string, text string")
    found = chat_parts.read_digests(chat_parts.format_turns(rows)).collect()
    said = "".join(f"{r}\n{t}\n" for r, t in turns).encode()
    learned = "".join(t for r, t in turns if r == "assistant")
    assert [(r.turns_sha256, r.loss_sha256, r.n_turns) for r in found] == [
        (hashlib.sha256(said).hexdigest(), hashlib.sha256(learned.encode()).hexdigest(),
         len(turns))] * bool(turns)


# 7

def test_top_k_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(700)]
    vectors += [(k, vectors[k % 2][1]) for k in range(700, 900)]
    odd = [(1000, None), (1050, [float("nan")] * 6), (1100, [None] * 6), (1150, [1.0]),
           (None, [1.0] * 6), vectors[0]]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<float>")
    found = {}
    for r in topk_nra.top_k(df, F.col("vec_id") % 50 == 0, block_rows=100, query_rows=4).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = {k: np.floor(256 * np.float32(v).astype(float)).astype(int) for k, v in vectors}
    assert sorted(found) == [k for k, _ in vectors if k % 50 == 0]
    for q, best in found.items():
        ranked = sorted((-int(whole[q] @ v), k) for k, v in whole.items() if k != q)[:5]
        assert sorted(best) == [(n + 1, k, -s) for n, (s, k) in enumerate(ranked)]
    assert topk_nra.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_broadcasts_no_copies_of_queries(spark):
    vectors = [(k, [float(k % 7), float(k % 11)]) for k in range(300)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = topk_nra.top_k(df, F.col("vec_id") % 50 == 0, block_rows=20, query_rows=2)
    assert "Broadcast" not in found._jdf.queryExecution().toString()


def test_large_components_are_not_clamped(spark):
    big = [2.0 ** 21, 2.0 ** 22, 3.0 * 2 ** 21, -(2.0 ** 23)]
    vectors = [(k, [x, float(k % 3), -1.0]) for k, x in enumerate(big * 3)]
    # Sums of products that pass the range of a long on the way to a score that does not.
    vectors += [(100, [2.0 ** 24, 2.0 ** 24, 1.0]), (101, [2.0 ** 24, -(2.0 ** 24), 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = topk_nra.top_k(df, F.col("vec_id").isin(0, 3, 101)).collect()
    whole = {k: [int(256 * x) for x in v] for k, v in vectors}
    for q in (0, 3, 101):
        ranked = sorted((-sum(a * b for a, b in zip(whole[q], v)), k)
                        for k, v in whole.items() if k != q)[:5]
        assert sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q) == [
            (n + 1, k, -s) for n, (s, k) in enumerate(ranked)]
    far = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="range of a long"):
        topk_nra.top_k(far, F.col("vec_id") == 0).collect()


@given(st.integers(0, 10_000), st.sampled_from([1, 3, 300, 2 ** 30]), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_lists_read_to_the_end_give_the_best(seed, scale, k):
    rng = np.random.default_rng(seed)
    n, dims = int(rng.integers(9, 120)), int(rng.integers(1, 8))
    ids = rng.permutation(n) - n // 2
    lists = topk_nra.SortedLists(ids, rng.integers(-scale, scale + 1, (n, dims)))
    query = rng.integers(-scale, scale + 1, dims)
    ranked = sorted((-int(lists.matrix[r] @ query), int(ids[r])) for r in range(n) if r)[:k]
    expected = [(-s, i) for s, i in ranked]
    assert lists.top(query, int(ids[0]), k, enough=8) == expected
    # With a floor from an earlier block, the rows that reach it are still found.
    floor = expected[len(expected) // 2][0]
    found = lists.top(query, int(ids[0]), k, float(floor), enough=8)
    assert [x for x in found if x[0] >= floor] == [x for x in expected if x[0] >= floor]


def test_queries_of_a_block_read_together():
    """Each query has its own rows, floor and depth, whatever the others need."""
    rng = np.random.default_rng(4)
    ids, rows = rng.permutation(900), rng.integers(-50, 51, (900, 6))
    rows[100:140] = rows[0]  # ties, to the smaller id
    lists, queries = topk_nra.SortedLists(ids, rows), rng.integers(-50, 51, (60, 6))
    queries[7], queries[8] = 0, rows[0]
    own = np.append(ids[:50], np.arange(2000, 2010))
    expected = [sorted(((int(r @ q), int(i)) for i, r in zip(ids, rows) if i != o),
                       key=lambda x: (-x[0], x[1]))[:5] for q, o in zip(queries, own)]
    none = np.full(60, -np.inf)
    for enough in (5, 64, 1000):
        assert lists.tops(queries, own, 5, none, enough) == expected
    floors = np.array([e[2][0] if k % 2 else -np.inf for k, e in enumerate(expected)])
    for best, floor, want in zip(lists.tops(queries, own, 5, floors, 8), floors, expected):
        assert [x for x in best if x[0] >= floor] == [x for x in want if x[0] >= floor]


def test_scores_wait_for_the_lists():
    """Components that are not read are not looked at before the lists have left few rows."""
    rng = np.random.default_rng(9)
    matrix = rng.integers(-9, 10, (4000, 3))
    matrix[:5] = 1000
    lists = topk_nra.SortedLists(np.arange(4000), matrix)
    expected = lists.top(np.array([1, 2, 3]), 4000, 5, enough=8)
    lists.held[:, 1000:3000] = np.nan  # beyond the depth at which the bounds decide
    assert lists.top(np.array([1, 2, 3]), 4000, 5, enough=8) == expected
    assert expected == [(6000, i) for i in range(5)]


# 8

def test_edited_texts_and_likeness(spark, docs_of):
    rows = order_minhash.fingerprints(docs_of(ODD)).orderBy(F.desc("doc_id")).collect()
    texts = [t or "" for t in reversed(ODD)]
    for k, row in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        assert row.edited_text == text[:len(text) - half] + after[:half]
        assert 0 <= row.near_edited <= 1 and row.n_chars == len(text) and row.pos == "x"
    by_text = {}
    for text, row in zip(texts, rows):
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
    assert order_minhash.fingerprints(docs_of([])).count() == 0
    one = order_minhash.fingerprints(docs_of(["a b c d"])).first()
    assert one.near_next == 1.0


def test_likeness_follows_order_and_edits(docs_of):
    words = [f"w{k}" for k in range(400)]
    moved = words[200:] + words[:200]
    edited = words[:390] + ["x"] * 10
    texts = [" ".join(x) for x in (words, edited, words, moved, words)]
    rows = order_minhash.fingerprints(docs_of(texts)).orderBy(F.desc("doc_id")).collect()
    near = {(r.doc_id, r.doc_id - 1): r.near_next for r in rows[:-1]}
    assert near[2, 1] > 0.7 and near[4, 3] < 0.75 and near[2, 1] > near[4, 3]


# 9

@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
@settings(max_examples=100, deadline=None)
def test_best_fit_and_its_bound(sizes):
    sizes = np.array(sizes)
    bins, offsets = bin_packing.best_fit_decreasing(sizes, 64)
    for b in range(bins.max() + 1):
        spans = sorted((offsets[k], sizes[k]) for k in np.flatnonzero(bins == b))
        assert all(a + n == c for (a, n), (c, _) in zip(spans, spans[1:]))
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= 64
    assert -(-sizes.sum() // 64) <= bin_packing.lower_bound(sizes, 64) <= bins.max() + 1


def test_pieces_fill_sequences(spark, docs_of):
    texts = ODD + [f"word{k} " * (k * 7 % 90) for k in range(300)]
    found = bin_packing.pack_documents(docs_of(texts), PATH, 128, partition_pieces=40).collect()
    tokenizer, own = Tokenizer.from_file(PATH), {}
    for r in found:
        own.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for k, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert sorted(own[k]) == [
            (p, a, len(ids[a:a + 128]), zlib.crc32(ids[a:a + 128].tobytes()))
            for p, a in enumerate(range(0, len(ids), 128))]
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        assert sum(n for _, n in spans) <= 128
    bound = bin_packing.lower_bound(np.array([r.length for r in found]), 128)
    assert len(sequences) <= bound + 3
    assert bin_packing.pack_documents(docs_of([]), PATH).count() == 0


# The pipeline

def test_stages_hand_documents_on(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        folder = f"{spark.sparkContext.getCheckpointDir()}/stage-{name.replace(' ', '-')}"
        out = stage(spark, docs, sf_dir)
        assert out.schema == docs.schema
        out.write.mode("overwrite").parquet(folder)
        docs = spark.read.parquet(folder)
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
