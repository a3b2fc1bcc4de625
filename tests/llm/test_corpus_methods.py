"""The later operators and mended parts against brute force and the library, and on odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tillflow.llm import (bin_packing, chat_parts, curve_packing, fp_search, line_crf, line_dedup,
                          near_dups, order_minhash, source_divergence, toxicity_fm, word_bpe)
from tillflow.llm.labelled import remainder, training_rows
from tillflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text, end=None):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return np.array(ids + ([] if end is None else [end]), "<u4")


# 1 and 8

def test_no_run_is_left_in_the_catalog(spark, docs_of):
    texts = [f"a line of some length {k % 5}\nanother long line {k}" for k in range(20)]
    rows = line_dedup.dedup_lines(docs_of(texts), batches=5).orderBy("doc_id").collect()
    assert [r.n_dropped for r in rows] == [0] * 5 + [1] * 15
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def brute_signature(text, k=3, length=2, sketches=64):
    def chain(*values):
        seed = 42
        for v in values:
            data = v if isinstance(v, bytes) else v[0].to_bytes(v[1], "little")
            seed = xxhash.xxh64_intdigest(data, seed)
        return seed

    words = []
    for word in re.split("[ \t-\r]+", text.strip(" \t\n\x0b\f\r")):
        whole = len(word) <= order_minhash.LONG
        units = [[word]] if whole else [word[i:i + 4] for i in range(len(word) - 3)]
        words += [chain(*[c.encode() for c in unit]) for unit in units]
    seen, ring = Counter(), []
    for i in range(max(len(words) - k, 0) + 1):
        kmer = chain(*[(w, 8) for w in words[i:i + k]]) >> 28
        ring.append((chain((kmer, 8), (seen[kmer], 4)) >> 28, i))
        seen[kmer] += 1
    ring.sort()
    out = []
    for sketch in range(sketches):
        first = next((n for n, (h, _) in enumerate(ring) if h >> 30 >= sketch), 0)
        chosen = sorted((i, h) for h, i in (ring[(first + j) % len(ring)] for j in range(length)))
        out.append(chain(*[(h, 8) for _, h in chosen]))
    return out


def test_signatures_are_those_of_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefgh", k=n)) for n in (1, 2, 3, 4, 9, 60, 400)]
    texts += ["", "  \n", "same " * 50, "É x\ty", "f of f", "\f\x0bf\x0b\f", "one two three one two three one two three"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", order_minhash.signature("text").alias("sig")).collect()
    for r in rows:
        assert [v % 2 ** 64 for v in r.sig] == brute_signature(r.text), r.text


def test_text_without_blanks_keeps_its_likeness_under_edits(spark, docs_of):
    rng = random.Random(4)
    text = "".join(rng.choice("天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏é𝄞") for _ in range(2000))
    edited = text[:700] + "x" + text[700:1500] + text[1501:]
    other = "".join(rng.sample(text, len(text)))
    moved = text[1000:] + text[:1000]
    short = "w" * order_minhash.LONG
    texts = [text, edited, other, moved, short, short + "w", "a " + text[:33] + " b"]
    rows = docs_of(texts).select("text", order_minhash.signature("text").alias("sig")).collect()
    for r in rows:
        assert [v % 2 ** 64 for v in r.sig] == brute_signature(r.text), r.text
    same = [sum(x == y for x, y in zip(rows[0].sig, r.sig)) / 64 for r in rows[:4]]
    assert same[0] == 1 and same[1] > 0.9 and same[2] < 0.1 and same[2] < same[3] < 0.9


def test_rows_with_one_id_or_none_meet_their_next(spark):
    rows = [(3, "c c c c"), (3, "b b b b"), (None, "n n"), (None, "m m"), (1, "a a a a"), (3, "b b b b")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sig string")
    found = order_minhash.fingerprints(docs).collect()
    order = [(3, "b b b b"), (3, "b b b b"), (3, "c c c c"), (1, "a a a a"), (None, "m m"), (None, "n n")]
    edited = {}
    for (_, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited.setdefault(text, set()).add(text[:len(text) - half] + after[:half])
    assert all(r.edited_text in edited[r.text] and r.sig == "x" for r in found) and len(found) == 6


# 3 and 10

def test_sample_bound_holds_for_repeated_ids(spark):
    docs = spark.createDataFrame([(k % 7, f"text {k}") for k in range(700)] + [(None, "x")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(7)] * 3, "doc_id long, toxic int")
    rows = training_rows(docs, labels, "toxic", F.lit(True), per_class=2).collect()
    assert Counter(r.label for r in rows) == {0: 2, 1: 2}
    again = training_rows(docs.repartition(5), labels, "toxic", F.lit(True), per_class=2).collect()
    assert sorted(rows) == sorted(again)


def test_chains_are_bounded_and_cover_all_texts(spark, monkeypatch):
    monkeypatch.setattr(line_crf, "CHAIN", 3)
    rows = spark.createDataFrame([(k % 2, f"line {k}\n" * (k + 1)) for k in range(9)],
                                 "label int, text string")
    found = line_crf.feature_rows(rows)
    assert found.where("further = 0").count() == 9
    assert found.agg(F.sum("lines")).first()[0] == sum(k + 2 for k in range(9))
    docs = spark.createDataFrame([(k, f"line {k}\n" * 40) for k in range(20)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    given = {}
    monkeypatch.setattr(line_crf, "train", lambda f, lines, y: given.update(
        lines=lines.sum(), chains=len(y)) or "model")
    assert line_crf.fit(docs, labels, F.lit(True), chains=25) == "model"
    assert given["chains"] == 25 and given["lines"] <= 75
    assert line_crf.score_texts(docs.limit(0), None).count() == 0


def test_agreeing_pairs_among_many_terms(spark):
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for k in range(2400):
        insult, group = rng.integers(0, 2, 2)
        filler = " ".join(f"w{x}" for x in rng.integers(0, 3000, 20))
        texts.append((k, f"{filler} {['friend', 'fool'][insult]} {['it', 'they'][group]}", 0.0))
        labels.append((k, int(insult == group)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, score double")
    truth = spark.createDataFrame(labels, "doc_id long, toxic int")
    fold = remainder("doc_id", 3)
    corpus_pipeline.shared_folder(spark)
    model = toxicity_fm.fit(docs, truth, fold != 1)
    found = toxicity_fm.score_texts(docs, model).where(fold == 1).join(truth, "doc_id").collect()
    right = np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in found])
    assert len(found) > 600 and right >= 0.95
    # Flat scoring equals the sum over all pairs; null and empty texts get the bias.
    sets = [toxicity_fm.term_buckets(t) for t in (texts[0][1], None, "", "fool they fool")]
    place = {int(b): k for k, b in enumerate(model.buckets)}
    for s, score in zip(sets, model.score(sets)):
        at = [place[b] for b in s if b in place]
        z = model.bias + sum(model.weights[at]) + sum(
            model.factors[a] @ model.factors[b] for a, b in itertools.combinations(at, 2))
        assert score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5)


# 4 and 9

def test_very_long_words_and_nothing(docs_of):
    random.seed(2)
    word = "".join(random.choices("abcdefghij", k=60_000))
    texts = [word, "a" * 5001, f"{word[:900]}!?{'é' * 700} b", "x " + word[:401]]
    own = word_bpe.load(PATH).encode_batch(texts)
    assert [x.tolist() for x in own] == [library_ids(t).tolist() for t in texts]
    assert word_bpe.code_texts(docs_of([]), PATH, decode=True).count() == 0


def test_known_chunks_are_forgotten_and_learned_again(monkeypatch):
    monkeypatch.setattr(word_bpe, "KNOWN_CHUNKS", 5)
    own = word_bpe.WordBpe(PATH)
    for text in ("one two three four, five six", "seven one two <|endoftext|> x", None, "one", ""):
        assert own.encode_batch([text, text])[1].tolist() == library_ids(text).tolist()


def test_only_partitions_with_a_gap_exchange(spark, monkeypatch):
    pieces = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("piece"),
        F.lit(0).cast("long").alias("start"), (F.col("id") % 37 + 20).alias("length"),
        F.lit(1).cast("long").alias("ids_crc32"))
    rounds, deal = [], bin_packing._pack_partitions

    def kept(pool, groups, seed, capacity):
        out = deal(pool, groups, seed, capacity)
        rows = out.collect()
        rounds.append(rows)
        return spark.createDataFrame(rows, out.schema)

    monkeypatch.setattr(bin_packing, "_pack_partitions", kept)
    found = {r.doc_id: r.sequence_id for r in bin_packing.pack_pieces(
        pieces, 100, partition_pieces=60).collect()}
    assert len(found) == 400 and len(rounds) >= 2
    second = {r.doc_id for r in rounds[1]}
    for r in rounds[0]:
        certified = r.bins == r.bound
        stays = certified and not r.loose
        assert (r.doc_id not in second) == stays
        if stays:
            assert found[r.doc_id] == (r.group << bin_packing.BIN_BITS) + r.bin


def test_sequence_ids_of_many_partitions_differ(spark):
    places = [(n, g, b) for n in (0, 1, 31) for g in (0, 2 ** 20, 2 ** 36 - 1) for b in (0, 9_999)]
    ids = {spark.range(1).select(bin_packing.sequence_ids(
        n, F.lit(g).cast("long"), F.lit(b).cast("long"))).first()[0] for n, g, b in places}
    assert len(ids) == len(places) and min(ids) >= 0
    with pytest.raises(ValueError):
        bin_packing.sequence_ids(32, F.lit(0), F.lit(0))


# 6

def test_roles_of_any_kind_come_back(spark):
    roles = ["a] b", "]", "x\\r] ", "<s>[ROLE:u] ", " ", "user", "assistant", "\\", None, "é] ]"]
    rows = [(c, t, r, f"text {t} </s> {r}") for c, picked in enumerate(
        itertools.permutations(roles, 2)) for t, r in enumerate(picked)]
    rows += [(None, 1, "user", "b"), (None, 1, "user", "a"), (None, 1, "user", "a"),
             (None, None, "a] b", None)]
    turns = spark.createDataFrame([(*r, "y") for r in rows],
                                  "conv_id long, turn long, role string, text string, body string")
    found = {r.conv_id: r for r in chat_parts.read_digests(
        chat_parts.format_turns(turns)).collect()}
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    for conv, group in groups.items():
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in sorted(group))
        assert found[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert found[conv].n_turns == len(group)


# 11

def brute_divergence(rows, least, ranks):
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = {c: c + 32 for c in range(65, 91)}
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(lower)) for _, _, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [(r[1], Counter(t)) for r, t in zip(rows, terms) if r[0] == lang]
        df = Counter(t for _, c in mine for t in c)
        kept = [t for t in df if df[t] >= least]
        count = {s: Counter() for s, _ in mine}
        for s, c in mine:
            count[s].update({t: c[t] for t in c if t in set(kept)})
        whole = sum(count.values(), Counter())

        def share(c, t):
            return 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s in count:
            pairs = [(-sum(abs(share(count[s], t) - share(count[o], t)) for t in kept), o.encode())
                     for o in count if o != s]
            tops = [(share(whole, t) - share(count[s], t), t.encode()) for t in kept
                    if count[s][t] and share(count[s], t) > share(whole, t)]
            for part, found in (("pair", pairs), ("term", tops)):
                out += [(lang, s, part, i.decode(), -v, n + 1)
                        for n, (v, i) in enumerate(sorted(found)) if part == "pair" or n < ranks]
    return sorted(out)


def test_divergence(spark, monkeypatch):
    rng = random.Random(6)
    words = ["Alpha", "beta,", "gamma-delta", "(beta)", "x1y", "É", "été", "a.b", "B.", "don't",
             "12", "--", "delta"]
    rows = [(rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None, "Z"]),
             "\t".join(rng.choices(words, k=rng.randrange(12)))) for _ in range(90)]
    rows += [("xx", "only", None), ("xx", "other", "rare words"), ("en", "empty", "")] + rows[:5]
    docs = spark.createDataFrame([(*r, 1) for r in rows],
                                 "lang string, source string, text string, chunk int")
    expected = brute_divergence(rows, 12, 4)
    for send in (1000, 0):
        found = source_divergence.audit_sources(docs.repartition(5), 12, 4, send)
        assert sorted(tuple(r) for r in found.collect()) == expected
    # Tiles of one term and two sources give the same sums.
    monkeypatch.setattr(source_divergence, "SOURCES", 2)
    monkeypatch.setattr(source_divergence, "TERMS", 1)
    found = source_divergence.audit_sources(docs, 12, 4)
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert source_divergence.audit_sources(docs.limit(0)).count() == 0


# 12

def test_hilbert_keys_walk_the_grid():
    for dims, bits in ((2, 4), (3, 3), (4, 2), (1, 5)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = curve_packing.hilbert_key(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_curve_packing(spark):
    rng = random.Random(7)
    topics = [[f"{t}{k}" for k in range(30)] for t in ("ship", "tree", "coin")]
    texts = [" ".join(rng.choices(topics[k % 3], k=60)) for k in range(60)]
    texts += [None, "", "long " * 900, texts[0], texts[0]]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, "no id", "x"), (0, texts[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    found = curve_packing.pack_along_curve(docs, PATH, 256).collect()
    sequences, pieces = {}, {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for spans in sequences.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        total = sum(n for _, n in spans)
        assert total <= 256 and total & (total - 1) == 0   # nothing is padded
    copies = Counter(k for k, _, _ in rows)
    for k, text, _ in rows:
        ids, own = library_ids(text, 1), pieces[k]
        assert {r.doc_tokens for r in own} == {len(ids)}
        assert sum(r.length for r in own) == copies[k] * len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    # Sequences hold like documents: few mix topics.
    mixed = [{r.doc_id % 3 for r in found if r.sequence_id == s and r.doc_id is not None
              and r.doc_id < 60} for s in sequences]
    assert np.mean([len(m) > 1 for m in mixed if m]) < 0.35
    assert curve_packing.pack_along_curve(docs.limit(0), PATH).count() == 0
    assert curve_packing.powers_of_two(1300) == [1024, 256, 16, 4]


# 13

def brute_search(docs, items, k):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = {c: c + 32 for c in range(65, 91)}
    own = [(d, Counter(re.findall(pattern, (t or "").translate(lower)))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked, scored = Counter(re.findall(pattern, (text or "").translate(lower))), []
        for d, c in own:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in asked.items())
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, n + 1, None if none else d, -s)
                for n, (s, none, d) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def test_search(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(40)] + ["Éa", "ÉA", "x-y", "7"]
    docs = [(k, " ".join(rng.choices(words, k=rng.randrange(40)))) for k in range(300)]
    docs += [(None, docs[3][1]), (None, "w1 w2"), (900, None), (901, ""), (902, "?!"),
             (903, docs[5][1]), (5, docs[5][1]), (904, "w1 " * 5000)]
    items = [(k, " ".join(rng.choices(words, k=8))) for k in range(9)]
    items += [(20, None), (21, "!?"), (22, "nowhere"), (23, "w1 w1 W1"), (None, "w2"), (0, "w3"),
              items[1]]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    expected = brute_search(docs, items, 7)
    found = fp_search.rank_documents(frame.repartition(3), asked, k=7, block_items=4)
    assert Counter(tuple(r) for r in found.collect()) == expected
    monkeypatch.setattr(fp_search, "LEAF", 3)
    found = fp_search.rank_documents(frame, asked, k=7)
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert fp_search.rank_documents(frame.limit(0), asked).count() == 0
    assert fp_search.rank_documents(frame, asked.limit(0)).count() == 0


def test_search_leaves_out_what_cannot_win():
    rng = np.random.default_rng(3)
    n, terms = 3000, 60
    rows, ranks = np.nonzero(rng.random((n, terms)) < 0.15)
    counts = rng.integers(1, 4, len(rows))
    counts[rows == 77] = 90
    m = rng.integers(25, 400, n)
    tree = fp_search.DocumentTree(rows, ranks, counts, m, terms)
    assert sum(b - a for (a, b), c in zip(tree.spans, tree.children) if not c) == n
    asked, weights = np.array([3, 9, 30]), np.array([5000, 3000, 100])
    best = fp_search.Counted(1)
    leaves = tree.search(asked, weights, list(range(n)), best)
    scores = np.zeros(n, np.int64)
    weight = dict(zip(asked.tolist(), weights.tolist()))
    for r, t, c in zip(rows.tolist(), ranks.tolist(), counts.tolist()):
        scores[r] += weight.get(t, 0) * (10 ** 9 * c // (1000 * c + 8 * int(m[r])))
    assert best.best() == [(int(scores.argmax()), int(scores.max()))]
    assert leaves < sum(not c for c in tree.children) / 2


# The pipeline

def brute_lines(docs):
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})
    owner = {}
    for doc_id, text in sorted(docs.items()):
        for line in (text or "").split("\n"):
            owner.setdefault(key(line), doc_id)
    return {d: "\n".join(x for x in (t or "").split("\n") if len(key(x)) < 10 or owner[key(x)] == d)
            for d, t in docs.items()}


def brute_copies(docs, percent):
    sets = {}
    for d, t in docs.items():
        w = (t or "").lower().split()
        sets[d] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    part = {d: d for d in docs}
    for a, b in itertools.combinations(sorted(docs), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            old, new = max(part[a], part[b]), min(part[a], part[b])
            part = {d: new if p == old else p for d, p in part.items()}
    return {d for d in docs if part[d] == d}


@pytest.fixture(scope="module")
def small_corpus(spark, tmp_path_factory):
    """Documents and labels: toxic ones, junk, shared lines, near copies, nulls."""
    rng = random.Random(9)
    words = [f"word{k}" for k in range(300)]
    shared = "this line stands in many of the documents."

    def prose(n=4):
        lines = [" ".join(rng.choices(words, k=9)).capitalize() + "." for _ in range(n)]
        return "\n".join(lines)

    texts, toxic, quality = [], [], []
    for k in range(240):
        bad, junk = k % 6 == 1, k % 6 == 3
        text = prose()
        if bad:
            text += "\nYou are a vile fool and a rotten liar."
        if junk:
            text = text.upper().replace(" ", "!! ## ")
        if k % 5 == 0:
            text += f"\n{shared}"
        texts.append(text)
        toxic.append(int(bad))
        quality.append(int(not junk))
    # A copy whose lines are divided otherwise, so that line dedup leaves it alone.
    parts = [" ".join(rng.choices(words, k=4 + k % 2)).capitalize() + "." for k in range(8)]
    base = "\n".join(f"{a} {b}" for a, b in zip(parts[::2], parts[1::2]))
    moved = "\n".join([parts[0], *(f"{a} {b}" for a, b in zip(parts[1:-1:2], parts[2::2])), parts[-1]])
    texts += [base, moved, None, "", "short text here"]
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                "n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, q, t) for k, (q, t) in enumerate(zip(quality, toxic))],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    return folder, toxic, quality


def test_stages_against_brute_force(spark, small_corpus, tmp_path):
    folder, toxic, quality = small_corpus
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def through(name, docs):
        stages[name](spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert out.schema.simpleString() == docs.schema.simpleString()
        return out, {r.doc_id: r.text for r in out.collect()}

    clean, left = through("toxicity", docs)
    corpus_pipeline.shared_folder(spark)
    model = toxicity_fm.fit(docs, labels, remainder("doc_id", 3) != 1)
    ids = sorted(texts)
    scores = dict(zip(ids, model.score([toxicity_fm.term_buckets(texts[d]) for d in ids])))
    assert left == {d: t for d, t in texts.items() if scores[d] < 0.7}
    assert {d for d in range(240) if toxic[d]} == set(range(240)) - set(left)

    good, left = through("quality", clean)
    model = line_crf.fit(clean, labels, remainder("doc_id", 5) != 0)
    kept = [r for r in clean.collect()]
    scores = line_crf.score_bytes(model, [(r.text or "").encode() for r in kept])
    assert left == {r.doc_id: r.text for r, s in zip(kept, scores) if s >= 0.3}
    assert {d for d in range(240) if not quality[d]}.isdisjoint(left)
    assert {d for d in range(240) if quality[d] and not toxic[d]} <= set(left)

    lines, after = through("line dedup", good)
    assert after == brute_lines(left)
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    single, left = through("near dedup", lines)
    assert set(left) == brute_copies(after, 80) and left == {d: after[d] for d in left}
    assert set(left) != set(after)

    packed = stages["packing"](spark, single, folder).collect()
    assert {r.doc_id for r in packed} == set(left)
    for d in list(left)[::9]:
        want = library_ids(left[d], 0)
        assert sum(r.length for r in packed if r.doc_id == d) == len(want)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole) == Counter(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)


def test_an_empty_table_passes_the_pipeline(spark, small_corpus, tmp_path):
    folder, _, _ = small_corpus
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(
            f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op4_word_bpe", "op9_bin_packing", "op12_curve_packing"])
def test_registered_token_queries(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(
        f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    end = {"op4_word_bpe": None, "op9_bin_packing": 0, "op12_curve_packing": 1}[name]
    want = {d: library_ids(t, end) for d, t in docs.items()}
    if end is None:
        assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in rows} == {
            d: (len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest())
            for d, x in want.items()}
        return
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start:r.start + r.length].tobytes())
    assert total == {d: len(x) for d, x in want.items()}


# 5

def family(rng, members, fewest=4, words=150):
    """Texts of one template with shares of words replaced that leave most pairs too unlike."""
    base = [f"t{k}" for k in range(words)]
    texts = []
    for n in range(members):
        text = list(base)
        for k in rng.choice(words, rng.integers(fewest, 9), replace=False):
            text[k] = f"m{n}x{k}"
        texts.append(" ".join(text))
    return texts


def word_sets(texts, size=5):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t.lower()) for t in texts]
    return [{tuple(w[i:i + size]) for i in range(len(w) - size + 1)} for w in words]


def brute_heads(texts, percent):
    sets, part = word_sets(texts), list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((part[a], part[b]))
            part = [low if p == high else p for p in part]
    return part


def test_large_bands_lose_no_link(docs_of, monkeypatch):
    rng = np.random.default_rng(21)
    texts = family(rng, 60)
    texts += [t.replace("t3 ", f"q{n} ") for n, t in enumerate(texts[::4])] + texts[:3]
    expected = brute_heads(texts, 80)
    assert 5 < len(set(expected)) < len(texts) - 10
    for few in (0, 64):
        monkeypatch.setattr(near_dups, "FEW", few)
        # Without rounds of heads the final pass has to find every link.
        monkeypatch.setattr(near_dups, "STAR_ROUNDS", 0 if few == 0 else 3)
        rows = near_dups.near_duplicates(docs_of(texts)).orderBy("doc_id").collect()
        assert [r.component_id for r in rows] == expected


@pytest.mark.parametrize("fewest", [1, 4])
def test_members_that_may_link_meet_and_few_others(spark, docs_of, fewest):
    texts = family(np.random.default_rng(22), 120, fewest)
    sets = near_dups.set_rows(docs_of(texts).withColumnRenamed("doc_id", "id"), 5)
    ids = spark.range(len(texts)).selectExpr("id", "id AS comp")
    met = near_dups.meeting_pairs(near_dups.rare_shingles(ids, sets, 80), 80).collect()
    found = {tuple(sorted((r.a, r.b))) for r in met}
    linked, brute = set(), word_sets(texts)
    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(brute[a] & brute[b])
        if 100 * common >= 80 * (len(brute[a]) + len(brute[b]) - common):
            linked.add((a, b))
    assert len(met) == len(found) and linked <= found
    assert linked if fewest == 1 else len(found) < 30
    one = ids.withColumn("comp", F.lit(0).cast("long"))
    assert near_dups.rare_shingles(one, sets, 80).count() == 0


def test_template_families_meet_where_they_differ(docs_of, monkeypatch):
    texts = family(np.random.default_rng(23), 120, 2)
    met, meeting_pairs = [], near_dups.meeting_pairs

    def watched(rare, percent):
        found = rare.groupBy("shingle").agg(F.countDistinct("id").alias("n"))
        met.append(found.agg(F.max("n")).first()[0] or 0)
        return meeting_pairs(rare, percent)

    monkeypatch.setattr(near_dups, "meeting_pairs", watched)
    monkeypatch.setattr(near_dups, "FEW", 16)
    for percent in (80, 85):
        rows = near_dups.near_duplicates(docs_of(texts), percent).orderBy("doc_id").collect()
        assert [r.component_id for r in rows] == brute_heads(texts, percent)
    # Of the shingles that most of them hold none is a meeting place.
    assert 0 < max(met) < len(texts) / 2


def test_links_with_a_centre_and_of_differences(spark, docs_of):
    texts = family(np.random.default_rng(24), 70, 1)
    sets = near_dups.set_rows(docs_of(texts).withColumnRenamed("doc_id", "id"), 5)
    members = spark.range(len(texts)).selectExpr(
        "id", "id AS comp", "0L AS family", "IF(id = 7, 2L, 1L) AS weight")
    beside = near_dups.centred(members, sets).cache()
    sized = word_sets(texts)
    found = {r.id: len(r.shingles) for r in beside.collect()}
    assert found == {n: len(x ^ sized[7]) for n, x in enumerate(sized)}
    links = {(r.a, r.b) for r in near_dups.links_with_centre(beside, 80).collect()}
    pairs = {(r.a, r.b) for r in near_dups.meeting_pairs(near_dups.rare_shingles(
        members.select("id", "comp"), beside.select("id", "n", "shingles"), 80), 80).collect()}
    part = list(range(len(texts)))
    for a, b in sorted(links | pairs):
        common = len(sized[a] & sized[b])
        linked = 100 * common >= 80 * (len(sized[a]) + len(sized[b]) - common)
        assert linked or (a, b) in pairs
        if linked:
            low, high = sorted((part[a], part[b]))
            part = [low if p == high else p for p in part]
    assert links and pairs - links and part == brute_heads(texts, 80)
