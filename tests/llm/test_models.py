"""Language identification, language-model scores, packing and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_set_operators import plain_classes, shingle_set
from test_text_operators import plain_lines, plain_words

import corpus_pipeline
from ratewell.llm import langid, mixing
from ratewell.llm.langid import fit_profiles, gram_counts, identify, keep_identified
from ratewell.llm.mixing import Code, score_texts
from ratewell.llm.packing import pack
from ratewell.llm.queries import op3_language_id, tokenizer_path


def plain_grams(text):
    grams = Counter()
    for word in "".join(c.lower() if c.isalpha() else " " for c in text).split():
        padded = f"_{word}_"
        for n in (1, 2, 3):
            grams.update(g for g in (padded[k : k + n] for k in range(len(padded) - n + 1)) if g.strip("_") and not (n == 2 and g == "__"))
    return grams


def test_grams_against_plain_counts():
    texts = ["Ab a b", "", "Äö 東京! x1y", "a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    row, gram, count = gram_counts(data, offsets)

    def spell(g):
        signs = [(g >> (21 * k)) & ((1 << 21) - 1) for k in (2, 1, 0)]
        return "".join("_" if s == 1 else chr(s - 2) for s in signs if s)

    for k, text in enumerate(texts):
        got = {spell(int(g)): int(c) for g, c in zip(gram[row == k], count[row == k])}
        assert got == dict(plain_grams(text))


@pytest.mark.parametrize("piece", [1, 5, 64])
def test_cuts_of_a_long_text_change_no_gram(monkeypatch, piece):
    texts = ["".join(chr(0x4E00 + k * 7 % 90) for k in range(400)), "Ab cd, " * 60 + "é" * 50, "x", "", "no-letters 123 " * 20, "z" * 300]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])

    def counted():
        return {(i + int(r), int(g)): int(c) for i, _, *found in langid._by_piece(data, offsets) for r, g, c in zip(*found)}

    whole = counted()
    monkeypatch.setattr(langid, "PIECE", piece)
    assert counted() == whole


def plain_distance(text, profile, size=300):
    """Out-of-place distance over the largest possible one, from the definition."""
    grams = plain_grams(text)

    def key(gram):
        code = 0
        for c in gram:
            code = code << 21 | (1 if c == "_" else ord(c) + 2)
        return code << 21 * (3 - len(gram))

    own = sorted(((-n, key(g)) for g, n in grams.items()))[:size]
    far = sum(abs(profile[g] - k) if g in profile else size for k, (_, g) in enumerate(own))
    return far / (len(own) * size)


def test_distances_and_winners_against_plain_ranking(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learn = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None]
    rank = {}
    for r in fit_profiles(spark.createDataFrame(learn, docs.schema)).collect():
        rank.setdefault(r.lang, {})[r.gram] = r.rank
    for r in identify(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        far = {lang: plain_distance(r.text, grams) for lang, grams in rank.items()}
        assert r.score == pytest.approx(1 - min(far.values()), abs=1e-9)
        assert far[r.lang_pred] == pytest.approx(min(far.values()), abs=1e-12)


def test_held_out_accuracy(spark):
    rows = op3_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = rows.join(truth, "doc_id").toPandas()
    assert len(got) == 1000
    expected = [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]
    assert got["held_out"].tolist() == expected
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_languages_of_odd_rows(docs, no_docs):
    got = identify(docs).toPandas()
    assert len(got) == docs.count()
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    for r in got.itertuples():
        known = (None if np.isnan(r.doc_id) else int(r.doc_id)) in letters
        assert (r.lang_pred != "und") == known and (known or r.score == 0)
    assert identify(no_docs).count() == 0
    kept = keep_identified(docs, fit_profiles(docs))
    assert kept.columns == docs.columns
    assert kept.where(F.col("text").isNull() | (F.col("doc_id") == 14)).count() == 0
    assert keep_identified(docs, fit_profiles(no_docs)).count() == 0


def test_code_is_a_prefix_code():
    hashes = np.arange(10, 60, dtype=np.uint64)
    code = Code(hashes, np.arange(1, 51), 7)
    assert abs(sum(2.0 ** -int(n) for n in code.length) - 1) < 1e-12
    words = {f"{int(v):0{int(n)}b}" for v, n in zip(code.value, code.length)}
    assert len(words) == 51 and not any(a != b and b.startswith(a) for a in words for b in words)


def test_scores_of_odd_rows(docs, no_docs):
    got = score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0).toPandas()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    learned = Counter()
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            learned.update([*plain_words(t, True), None])
    n, v = sum(learned.values()), len(learned)
    wanted = sorted(
        (str(i), len(plain_words(t)) + 1, sum(learned[w] > 0 for w in [*plain_words(t, True), None]),
         round(sum(np.log10((learned[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*plain_words(t, True), None]), 6))
        for i, t in rows
    )
    mine = sorted((str(None if np.isnan(r.doc_id) else int(r.doc_id)), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got.itertuples())
    assert mine == wanted
    assert (got["train_tokens"] == n).all() and (got["score"] < 0).all() and np.isfinite(got["score"]).all()
    assert score_texts(no_docs, F.lit(True)).count() == 0


def test_model_beats_the_base_on_held_out_text(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = score_texts(table, F.crc32(F.col("doc_id").cast("string")) % 10 == 0).toPandas()
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()
    assert held["bits_per_byte"].between(0, 8).mean() > 0.98


def check_packing(pieces, rows, window):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    coded = sorted((str(i), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows)
    by_doc = {}
    for r in pieces:
        by_doc.setdefault(str(r.doc_id), []).append(r)
    for i in {i for i, _ in coded}:
        texts = [ids for j, ids in coded if j == i]
        wanted, got = Counter(), Counter()
        for ids in texts:
            wanted.update((k, len(ids)) for k in range(len(ids)))
        for r in by_doc[i]:
            got.update((k, r.doc_tokens) for k in range(r.start, r.start + r.length))
            crcs = {zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for ids in texts if len(ids) == r.doc_tokens}
            assert r.ids_crc32 in crcs
        assert got == wanted
    total = sum(len(ids) for _, ids in coded)
    places = sorted((r.sequence_id, r.offset, r.length) for r in pieces)
    at = 0
    for sequence, offset, length in places:
        assert sequence * window + offset == at and offset + length <= window
        at += length
    assert at == total


def test_pieces_give_back_every_id(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for bucket_rows in (1000, 3):
        check_packing(pack(docs, tokenizer_path(), window=256, quantum=64, bucket_rows=bucket_rows).collect(), rows, 256)
    assert pack(no_docs, tokenizer_path()).count() == 0


def test_special_and_joined_signs_are_encoded_like_whole_texts(spark):
    texts = ["a<|endoftext|>b <|STARTOFTEXT|> x", "it's the é ́ b​c", "1234 don't  WE'LL\x0b!!??", "ﬁ Å İ ß ΑΣ"]
    check_packing(pack(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string"), tokenizer_path()).collect(), list(enumerate(texts)), 2048)


def test_windows_follow_the_mixture(spark, sample):
    pieces = pack(sample, tokenizer_path(), window=2048, quantum=64).toPandas()
    whole = pieces.groupby("source")["length"].sum() / pieces["length"].sum()
    full = pieces[pieces["sequence_id"] < pieces["sequence_id"].max()]
    shares = full.groupby(["sequence_id", "source"])["length"].sum().unstack(fill_value=0) / 2048
    carried = (shares - whole).cumsum().abs() * 2048
    assert carried.to_numpy().max() <= 64 * 24  # the deficit stays bounded from window to window


@pytest.fixture(scope="module")
def stages(spark, sample):
    out, docs = {}, sample
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs, stage(spark, docs, "/root/testdata/sf0.001").cache()
        docs = out[name][1]
    return out


def test_stages_keep_the_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.schema == before.schema, name


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages["language"]
    assert after.count() == before.count()


def test_line_stage(stages):
    before, after = stages["lines"]
    wanted = [(i, t) for i, _, _, t in plain_lines([(r.doc_id, r.text) for r in before.collect()]) if plain_words(t)]
    assert sorted((r.doc_id, r.text) for r in after.collect()) == sorted(wanted)
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in plain_classes(rows)})


def test_decontamination_stage(spark, stages):
    before, after = stages["decontaminate"]
    items = [shingle_set(r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    clean = [r.doc_id for r in before.collect() if not any(100 * len(s & shingle_set(r.text)) >= 80 * len(s) for s in items if s)]
    assert sorted(r.doc_id for r in after.collect()) == sorted(clean)


def test_pack_stage(stages):
    before, after = stages["pack"]
    check_packing(after.collect(), [(r.doc_id, r.text) for r in before.collect()], 2048)


def test_run_is_the_stages_in_order(spark, stages):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()))[:50] == sorted(map(tuple, stages["pack"][1].collect()))[:50]


def test_context_counts_are_exact_at_any_size():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(w)}" for w in rng.zipf(1.3, 300) % 500) for _ in range(12)]
    held = [k % 4 == 0 for k in range(12)]
    tables = [pa.table({"text": texts[a : a + 4], "held_out": held[a : a + 4], "block": pa.array([b] * 4, pa.int32())}) for b, a in enumerate(range(0, 12, 4))]
    learned = Counter(h for t in tables for h in mixing.tokens(*mixing.flat(t.filter(pa.array([not x for x in t["held_out"].to_pylist()]))["text"])).hashes.tolist())
    best = sorted(learned, key=lambda h: (-learned[h], h))[:60]  # the others are spelled
    code = Code(np.array(best, np.uint64), np.array([learned[h] for h in best]), sum(learned.values()) - sum(learned[h] for h in best))
    sent = pa.concat_tables(mixing._send_paths(code, 2)(t) for t in tables).to_pandas()
    back = pa.concat_tables(
        mixing._total_paths(pa.Table.from_pandas(g.reset_index(drop=True))) for _, g in sent.groupby(["context", "bucket"])
    )
    for k in range(mixing.CONTEXTS):
        wanted = {}  # zeros and ones after every unit and path, counted bit by bit
        for t in tables:
            flags = t["held_out"].to_pylist()
            for i, _, layout in mixing._pieces(*mixing.flat(t["text"]), code):
                for u, v, n, o in zip(*(x.tolist() for x in layout.paths[k])):
                    for d in range(n):
                        key = u, d, v >> (64 - d)
                        wanted.setdefault(key, [0, 0])[v >> (63 - d) & 1] += not flags[layout.row[o] + i]
        for b, t in enumerate(tables):
            leaves, _, _ = mixing._gathered(t, code, k)
            mine = back.filter(pa.compute.equal(back["block"], b))
            context = mixing._context(t, mine, code, k, 0)
            for u, v, n, first in zip(*(x.tolist() for x in leaves[:3]), context.first.tolist()):
                for d in range(n):
                    zeros, ones = wanted[u, d, v >> (64 - d)]
                    says = round(float(np.log((ones + 0.4) / (zeros + 0.4))) * 256) * 4 + sum(zeros + ones >= x for x in (2, 8, 64))
                    assert abs(int(context.says[first + d]) - says) <= 4


def test_contexts_and_stride_are_whole():
    hashes = np.array([7, 9, 7, 9, 5], np.uint64)
    got = mixing.Tokens(hashes, np.array([0, 4, 5]), np.zeros(5, np.int64), np.zeros(5, np.int64))
    units, _, _ = mixing._units(got, Code(np.array([5, 7, 9], np.uint64), np.array([1, 2, 3]), 0))
    assert len(units) == mixing.CONTEXTS == 4
    pairs = units[2].tolist()  # (7, 9) differs from (nothing, 9) and both ends of a row see nothing before
    assert len({pairs[k] for k in (0, 1, 2, 3)}) == 4 and pairs[0] == pairs[4]
    assert mixing._stage(np.array([0, 1023, 1024, 5000])).tolist() == [0, 0, 1, 4]


def test_first_weights_use_every_training_document(spark, monkeypatch):
    seen = {}
    real = mixing._fit

    def fit(blocks, *rest):
        seen["rows"] = blocks.where(~F.col("held_out")).count()
        seen["weights"] = real(blocks, *rest)
        return seen["weights"]

    monkeypatch.setattr(mixing, "_fit", fit)
    texts = [(k, f"same words {k % 3}") for k in range(12_000)]
    score_texts(spark.createDataFrame(texts, "doc_id long, text string"), F.col("doc_id") % 10 == 0)
    assert seen["rows"] == 10_800 and seen["weights"].shape == (32, 4)


def plain_mixer(bits, weights):
    """Log2 probability of one text's bits, bit by bit in the order of the text."""
    order = np.argsort(bits.place)
    w = weights.astype(float).copy()
    centre = 1 / (1 + np.exp(-(np.arange(mixing.LEVELS) - mixing.LEVELS // 2) / 2))
    ones, every = np.tile(64 * centre, (mixing.GATES, 1)), np.full((mixing.GATES, mixing.LEVELS), 64.0)
    total, waiting = 0.0, []
    for number, k in enumerate(order):
        if number % 1024 == 0 and number:
            slope, seen = np.zeros_like(w), np.zeros(mixing.GATES)
            for gate, x, error, level, bit in waiting:
                slope[gate] += error * x
                seen[gate] += 1
                ones[gate, level] += bit
                every[gate, level] += 1
            w += 0.5 * slope / (seen[:, None] + 64)
            waiting = []
        says = [int(s[k]) for s in bits.says]
        x = np.array([(s >> 2) / 256 for s in says])
        gate = int(bits.spelled[k]) * 16 + (says[1] & 3) * 4 + (says[2] & 3)
        odds = min(16, max(-16, float(x @ w[gate])))
        p = 1 / (1 + np.exp(-odds))
        level = min(mixing.LEVELS - 1, max(0, int(odds * 2 + mixing.LEVELS / 2)))
        final = min(1 - 1e-6, max(1e-6, (p + ones[gate, level] / every[gate, level]) / 2))
        bit = int(bits.bit[k])
        total += np.log2(final if bit else 1 - final)
        waiting.append((gate, x, bit - p, level, bit))
    return total


@pytest.mark.parametrize("piece", [60, 700, 5000])
def test_long_texts_score_alike_in_any_pieces(monkeypatch, piece):
    rng = np.random.default_rng(4)
    words = [" ".join(f"w{int(w)}" for w in rng.zipf(1.2, n) % 900) for n in (3, 1500, 40)]
    t = pa.table({"text": [*words, "", "x" * 900], "held_out": [False] * 5, "block": pa.array([0] * 5, pa.int32())})
    learned = Counter(mixing.tokens(*mixing.flat(t["text"])).hashes.tolist())
    best = sorted(learned, key=lambda h: (-learned[h], h))[:300]
    code = Code(np.array(best, np.uint64), np.array([learned[h] for h in best]), sum(learned.values()) - sum(learned[h] for h in best))
    weights = (mixing._start() * 0.9).astype(np.float32)

    def answers():
        sent = mixing._send_paths(code, 2)(t).to_pandas()
        parts = [mixing._total_paths(pa.Table.from_pandas(g.reset_index(drop=True))) for _, g in sent.groupby(["context", "bucket"])]
        return pa.concat_tables(parts)

    def scores():
        out, state, before = np.zeros(5), None, -1
        for i, j, part in mixing._whole_stages(mixing._bits(t, answers(), code, 0)):
            if i != before:
                state = {} if j == i + 1 else None
            out[i:j] += mixing.mix_online(part, j - i, weights, state)
            before = i
        return out

    whole = scores()
    ((_, _, bits),) = mixing._bits(t, answers(), code, 0)
    plain = [plain_mixer(mixing._chosen(bits, bits.row == k), weights) for k in range(5)]
    assert whole == pytest.approx(plain, rel=1e-4)
    monkeypatch.setattr(mixing, "PIECE", piece)
    assert len(list(mixing._pieces(*mixing.flat(t["text"]), code))) > 1
    assert scores() == pytest.approx(whole, rel=1e-6)
