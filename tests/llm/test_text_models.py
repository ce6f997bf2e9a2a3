"""Lattice scorer, SentencePiece codec, token files, language ID, toxicity: brute force, round trips, awkward rows."""

import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from kestrel.llm import language_id, lattice, sentencepiece_codec, token_files, toxicity
from kestrel.llm.common import Memo, hash_below, shared_folder, smallest_hashes
from kestrel.llm.queries import PIECES, TOKENIZER, vocabulary

SCHEMA = "doc_id long, text string, lang string, toxic string, ids string"
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "123 !!"), (5, "word " * 30_000), (6, "x" * 50_000), (7, "The same"), (7, "The same"),
           (None, "no id here"), (8, "é▁日本   a  b   c"), (9, " lead"), (10, "tail ")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "q", "w") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def model():
    return sentencepiece_codec.PieceModel(vocabulary(PIECES))


# ---------------------------------------------------------------- SentencePiece

def full_viterbi(model, text):
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + model.longest) + 1):
            v = model.score.get(text[i:j], model.unknown if j == i + 1 else None)
            if v is not None and best[i][0] + v > best[j][0]:
                best[j] = (best[i][0] + v, i)
    out, k = [], len(text)
    while k:
        out.append(text[best[k][1]:k])
        k = best[k][1]
    return [i for p in reversed(out) for i in model.emit(p)]


def test_streaming_viterbi_equals_the_full_one_in_a_bounded_window(model):
    rng, held = random.Random(2), []
    for n in [*range(0, 140, 3), 900, 4000]:
        text = "".join(rng.choice("▁theanrösß日x,") for _ in range(n))
        assert sentencepiece_codec.viterbi(model, text, held.append) == full_viterbi(model, text)
    assert sentencepiece_codec.viterbi(model, "the" * 20_000, held.append)[:2] == full_viterbi(model, "the" * 200)[:2]
    assert max(held) < 8 * model.longest


def test_viterbi_equals_the_library_on_the_same_scores(model, tmp_path):
    """The library's own unigram encoder on a model file that holds our pieces and scores."""
    sentencepiece = pytest.importorskip("sentencepiece")
    import struct

    def varint(n):
        out = b""
        while True:
            out += bytes([n & 127 | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                return out

    def field(number, raw):
        return varint(number << 3 | 2) + varint(len(raw)) + raw

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + varint(3 << 3) + varint(kind))

    pieces = piece("<unk>", 0.0, 2) + b"".join(piece(p, s, 1) for p, s in model.score.items())
    trainer = field(2, varint(3 << 3) + varint(1))                                            # unigram
    normalizer = field(3, field(1, b"identity") + b"".join(varint(n << 3) + varint(v) for n, v in ((3, 1), (4, 0), (5, 1))))
    try:
        sp = sentencepiece.SentencePieceProcessor(model_proto=pieces + trainer + normalizer)
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"the library does not load the file: {e}")
    encoder, differ = sentencepiece_codec.PieceEncoder(vocabulary(PIECES)), 0
    for word in "the anthblely hestwh of reading ingatea onenesen Keitkeitkeit llueosdo Miraga".split():
        ids = encoder(word).tolist()
        got = [sp.id_to_piece(i) for i in sp.encode(word)]
        mine = [next(p for p, k in model.id.items() if k == i) for i in ids]
        total = lambda ps: sum(model.score[p] for p in ps)
        assert total(mine) >= total(got) - 1e-4
        differ += mine != got
    assert differ == 0


def test_codec_round_trip_and_awkward_rows(spark, model):
    df = frame(spark, AWKWARD)
    got = sentencepiece_codec.encode_documents(df, vocabulary(PIECES))
    rows = got.collect()
    assert got.columns == ["doc_id", "ids", "n_ids", "n_chars", "round_trip"] and len(rows) == len(AWKWARD)
    assert all(r.round_trip and len(r.ids) == r.n_ids for r in rows)
    back = sentencepiece_codec.decode_documents(got, vocabulary(PIECES)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in AWKWARD)
    assert sentencepiece_codec.encode_documents(df.limit(0), vocabulary(PIECES)).count() == 0


# ---------------------------------------------------------------- token files

def test_chunked_encoding_equals_the_library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(TOKENIZER))
    encode, rng = token_files.ChunkEncoder(vocabulary(TOKENIZER)), random.Random(4)
    texts = ["", " ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n\n b", "it's we'll 12 34,5", "x y   z", "<|endoftext|> x", "\t\t x"]
    texts += ["".join(rng.choice("ab 's1\n\t é,") for _ in range(60)) for _ in range(400)]
    texts += ["".join(rng.choice("ab 日é's<|1") for _ in range(40)) for _ in range(200)]
    want = [t.encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(x, encode.dtype).tolist() for x in encode(texts)] == want
    small = token_files.ChunkEncoder(vocabulary(TOKENIZER), limit=20)                     # the memo turns over all the time
    assert [np.frombuffer(small([text])[0], encode.dtype).tolist() for text in texts] == want


def test_token_files_read_back(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(TOKENIZER))
    rows = sorted([r for r in AWKWARD if r[0] is not None], key=lambda r: (r[0], r[1] or ""))
    want, start, flat = [], 0, []
    for i, text in [(None, "no id here"), *rows]:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        flat += ids
    df = frame(spark, AWKWARD).repartition(3)
    got = token_files.token_file_digest(df, vocabulary(TOKENIZER)).collect()
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got], key=lambda r: r[1]) == want
    manifest = token_files.write_token_files(df, shared_folder(spark, "t"), vocabulary(TOKENIZER), length=16, rows=4).orderBy("part").collect()
    seen = []
    for m in manifest:
        file, left, i = token_files.TokenFile(m.path), m.tokens, 0
        while left > 0:
            ids, mask = file.sequence(i)
            assert len(ids) == len(mask) == 16 and mask.sum() == min(16, left) and not ids.flags.owndata
            seen += ids[mask].tolist()
            left, i = left - 16, i + 1
    assert seen == flat
    assert token_files.token_file_digest(df.limit(0), vocabulary(TOKENIZER)).count() == 0


# ---------------------------------------------------------------- lattice

def every_segmentation(model, score, text):
    if not text:
        return 1.0
    total, char = 0.0, text[0]
    if char not in score:
        total += math.exp(lattice.outside(char)) * every_segmentation(model, score, text[1:])
    for j in range(1, min(len(text), model.longest) + 1):
        if text[:j] in score:
            total += math.exp(score[text[:j]]) * every_segmentation(model, score, text[j:])
    return total


def test_marginal_sums_all_segmentations(model):
    trie = model.with_prefixes(model.score, sentencepiece_codec.NEVER)
    for word in ("the", "anthblely", "日本x", "a▁b", "zq", "ingation"):
        want = every_segmentation(model, model.score, lattice.escaped(word.encode()))
        assert abs(lattice.marginal(trie, word.encode()) - math.log(want)) < 1e-9
    long = lattice.marginal(trie, b"thering" * 5000)
    assert -1e6 < long < -1e4


def test_expected_pieces_add_up_to_the_word(model):
    weight = {p: math.exp(s) for p, s in model.score.items()}
    into = {}
    lattice.expected_pieces(model.with_prefixes(weight, 0.0), b"anthblely", into)
    assert abs(sum(len(p) * n for p, n in into.items()) - len("anthblely") - 1) < 1e-9


def test_lattice_counts_base_and_head_size_do_not_change_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    learn = F.col("doc_id") % 3 != 0
    got = {r.doc_id: r for r in lattice.score_documents(docs, learn, vocabulary(PIECES)).collect()}
    small = {r.doc_id: r for r in lattice.score_documents(docs, learn, vocabulary(PIECES), head=50).collect()}
    rows, c, ends = docs.collect(), Counter(), 0
    for r in rows:
        if r.doc_id % 3:
            c.update(r.text.encode().lower().split())
            ends += 1
    total, types = sum(c.values()) + ends, len(c) + 1
    for r in rows:
        words = r.text.encode().lower().split()
        base = sum(math.log10((c[w] + 1) / (total + types + 1)) for w in words) + math.log10((ends + 1) / (total + types + 1))
        for x in (got[r.doc_id], small[r.doc_id]):
            assert (x.n_tokens, x.n_known, x.train_tokens) == (len(words) + 1, sum(w in c for w in words) + 1, total)
            assert abs(x.base_score - base) < 1e-6 * abs(base)
        assert abs(got[r.doc_id].score - small[r.doc_id].score) < 1e-6 * abs(base) and got[r.doc_id].score < 0


def test_lattice_awkward_rows(spark):
    df = frame(spark, AWKWARD)
    got = lattice.score_documents(df, F.lit(True), vocabulary(PIECES)).collect()
    assert len(got) == len(AWKWARD) and all(r.score is not None and np.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    none = lattice.score_documents(df, F.lit(False), vocabulary(PIECES)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) for r in none)
    assert lattice.score_documents(df.limit(0), F.lit(True), vocabulary(PIECES)).count() == 0


def decimal_marginal(model, word):
    """All segmentations summed in decimals with an exponent of any size."""
    from decimal import Decimal
    text = lattice.escaped(word.encode())
    weight = {p: Decimal(s).exp() for p, s in model.score.items() if p in text}
    total = [Decimal(1)] + [Decimal(0)] * len(text)
    for i, char in enumerate(text):
        if char not in weight:
            total[i + 1] += total[i] * Decimal(lattice.outside(char)).exp()
        for j in range(i + 1, min(len(text), i + model.longest) + 1):
            if text[i:j] in weight:
                total[j] += total[i] * weight[text[i:j]]
    return total[-1]


def test_long_unseen_words_keep_their_own_probability(spark, model):
    from decimal import Decimal
    words = ["zq", "the" * 300, "thering" * 600, "日本語" * 700, "x9/" * 1500]
    rows = spark.createDataFrame([(w.encode(), [0, 0], 1) for w in words] + [(b"seen" * 400, [3, 0], 3)], "word binary, c array<bigint>, n long")
    tokens, types = [100, 40], [20, 10]
    got = {bytes(r.word).decode(): r.p for r in lattice.weigh(rows, model.score, vocabulary(PIECES), tokens, types).collect()}
    for word in words:
        spelled = decimal_marginal(model, word)
        for k in range(2):
            want = (Decimal(lattice.DISCOUNT * types[k] / tokens[k] * (1 - lattice.ACROSS)) * spelled).log10()
            assert abs(got[word][k] - float(want)) < 1e-9 * abs(float(want)) + 1e-9
    assert min(got[w][0] for w in words) < -2000
    freed, common = lattice.DISCOUNT * np.array(types) / tokens, (3 - lattice.DISCOUNT) / sum(tokens)
    own = np.array([(3 - lattice.DISCOUNT) / 100, 0]) + freed * lattice.ACROSS * common
    assert np.allclose(got["seen" * 400], np.log10(own), rtol=1e-12)


@pytest.mark.parametrize("head", [1000, 1])
def test_documents_of_long_unseen_words_do_not_tie(spark, head):
    docs = spark.createDataFrame([(0, "plain words"), *[(n, "日本" * n) for n in (200, 2000, 20_000)]], "doc_id long, text string")
    got = {r.doc_id: r.score for r in lattice.score_documents(docs, F.col("doc_id") == 0, vocabulary(PIECES), class_col=None, head=head).collect()}
    assert got[200] > got[2000] > got[20_000] and 9 < got[20_000] / got[2000] < 11


# ---------------------------------------------------------------- language ID

def test_counts_in_blocks_equal_counts_at_once(monkeypatch):
    text = "Ein Satz, der lang ist. ÜBER " * 400
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "BLOCK", 97)
    assert (language_id.counts(text) == whole).all()
    assert (language_id.group_counts([text, "12"])[0][0] == whole).all()


def test_language_held_out_accuracy_and_awkward_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    aside = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language_id.train(docs, ~aside, per_label=150)
    assert (model.weights == 0).mean() > 0.3                        # elastic net leaves weights at zero
    j = language_id.predict(docs, model).join(docs, "doc_id").where(aside)
    assert j.where("lang_pred = lang").count() >= 0.98 * j.count()
    assert j.where("score < 0 or score > 1").count() == 0
    got = language_id.predict(frame(spark, AWKWARD), model).collect()
    assert len(got) == len(AWKWARD)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (1, 2, 3, 4)} == dict.fromkeys((1, 2, 3, 4), "und")
    assert language_id.predict(docs.limit(0), model).count() == 0
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.train(docs.limit(0), F.lit(True)) is None
    one = language_id.train(docs.where("lang = 'de'"), F.lit(True), per_label=20)
    assert {r.lang_pred for r in language_id.predict(docs, one).collect()} == {"de"}
    kept = language_id.accepted(frame(spark, AWKWARD), model)
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ") and kept.count() == len(AWKWARD) - 4


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 2000)
    z = rng.normal(size=(2000, 3)) + 2.0 * np.eye(3)[y]
    assert abs(language_id.fit_temperature(z * 5, y) - 5 * language_id.fit_temperature(z, y)) < 0.2


def test_a_sample_of_any_number_of_rows_has_rows(spark, monkeypatch):
    """A group estimated at 2e12 rows: the share is far below a millionth and still a share."""
    h = F.xxhash64("id")
    share = spark.range(1 << 20).where(hash_below(h, 3e-5)).count()
    assert 10 < share < 70
    asked = spark.range(1).select(hash_below(F.lit(-(1 << 63) + 10**7), 1550 / 2e12).alias("a"), hash_below(F.lit(0), 1550 / 2e12).alias("b")).first()
    assert asked.a and not asked.b
    rows = spark.range(5000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    many = rows.unionByName(rows.where("id = 10").crossJoin(spark.range(3000).select()))         # one row as most of its group
    got, sizes = smallest_hashes(many, ["id"], 200, "y")
    assert {r.y: r["count"] for r in got.groupBy("y").count().collect()} == {0: 200, 1: 200} and got.distinct().count() == 400
    assert sizes.keys() == {0, 1}


def test_copies_of_one_row_crowd_no_language_out(spark):
    rows = [(1, "the same words again and again", "en")] * 3000 + [(i, f"ein Satz mit Nummer {'abcdefghij'[i % 10] * 3} darin", "de") for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs, F.lit(True), per_label=40)
    assert model.labels == ["de", "en"]


def test_a_label_of_long_texts_alone_is_learned_from_blocks(spark):
    """9,000 words and more, where the descent reads at most 4,000: blocks of these texts teach the label."""
    docs = spark.createDataFrame([(i, ("vile awful " * 5000 if i < 8 else "kind words here " * 10) + f"number{i}") for i in range(40)],
                                 "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 8).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels, F.lit(True))
    got = {r.doc_id: r.predicted for r in toxicity.predict(docs, model).collect()}
    assert got == {i: int(i < 8) for i in range(40)}


def test_long_words_are_made_anew_and_never_held():
    calls = []
    memo = Memo(lambda k: calls.append(k) or len(k), limit=10)
    assert [memo["x" * 500], memo["x" * 500], memo["short"], memo["short"]] == [500, 500, 5, 5]
    assert calls == ["x" * 500, "x" * 500, "short"] and list(memo) == ["short"]


def test_chunks_are_bounded_in_bytes_and_long_ones_pass():
    """Thousands of long texts without spaces fill no memory, and ids stay the library's."""
    draw = random.Random(2)
    encoder = token_files.ChunkEncoder(vocabulary(TOKENIZER), limit=40_000)
    for _ in range(60):
        texts = [" ".join("".join(draw.choices("abcdeé日,.", k=draw.choice([3, 8, 400]))) for _ in range(20)) for _ in range(5)]
        for raw, text in zip(encoder(texts), texts):
            assert np.frombuffer(raw, encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        held = sum(4 * len(c) + len(v) + 200 for c, v in encoder.memo.known.items())
        assert held <= 40_000 + 100 * 900 and max(map(len, encoder.memo.known)) <= token_files.ChunkMemo.LONGEST


# ---------------------------------------------------------------- toxicity

def test_toxicity_held_out_and_awkward_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    aside = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.train(docs, labels, ~aside, per_class=800)
    j = toxicity.predict(docs, model).join(labels, "doc_id").where(aside)
    n = {(r.toxic, r.predicted): r["count"] for r in j.groupBy("toxic", "predicted").count().collect()}
    hit, wrong, missed = n.get((1, 1), 0), n.get((0, 1), 0), n.get((1, 0), 0)
    assert hit / (hit + wrong) > 0.8 and hit / (hit + missed) > 0.6      # a fifth of the toxic labels have no toxic word
    got = toxicity.predict(frame(spark, AWKWARD), model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1 and len({r.score for r in got if r.doc_id == 7}) == 1
    assert toxicity.predict(docs.limit(0), model).count() == 0
    assert toxicity.train(docs, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in toxicity.predict(docs.limit(3), None).collect()} == {0.0}


def test_thresholds_do_not_move_with_the_share_in_the_descent():
    """The same rows with a tenth, half or most of the clean ones in the descent: one threshold."""
    rng = np.random.default_rng(5)
    made = []
    for kept in ((0.9, 0.9), (0.5, 0.1), (0.1, 0.9)):
        found = []
        for c, (mean, size) in enumerate(((-1.0, 900_000), (1.0, 100_000))):
            bins, n = np.unique(np.floor(rng.normal(mean, 1, size) * toxicity.BINS).astype(int), return_counts=True)
            out = rng.binomial(n, kept[c])
            found += [(0, c, 1, place, b, m) for b, o, i in zip(bins, out, n - out) for place, m in ((0, o), (1, i)) if m]
        model = toxicity.ToxicityModel({}, None, {}, None, None, 0.0, np.zeros(5))
        toxicity._calibrate(model, np.array(found))
        made.append(model.threshold[0])
    assert max(made) - min(made) < 0.15
    grid = np.linspace(-2, 4, 601)                        # F1 of two normals at 10 % toxic
    above = lambda mean: np.array([0.5 * math.erfc((g - mean) / math.sqrt(2)) for g in grid])
    f1 = 2 * 0.1 * above(1) / (0.1 * above(1) + 0.9 * above(-1) + 0.1)
    assert abs(np.mean(made) - grid[f1.argmax()]) < 0.15


def test_all_labelled_rows_are_calibrated(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "_calibrate", lambda model, found: seen.append(found))
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), labels, F.lit(True), per_class=100)
    y, inside, n = seen[0][:, 1], seen[0][:, 3], seen[0][:, 5]
    assert [n[y == c].sum() for c in (0, 1)] == [labels.where(F.col("toxic") == c).count() for c in (0, 1)]
    assert all(n[(y == c) & (inside == 1)].sum() <= 100 for c in (0, 1))


def test_maxima_in_blocks_equal_maxima_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    model = toxicity.ToxicityModel({}, rng.normal(size=(50, toxicity.DIM)), {w: rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS},
                                   np.zeros(24), np.zeros(24), 0.0, np.zeros(5)).prepare()
    rows = rng.integers(0, 50, 1000)
    whole = model.maxima(rows)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert np.allclose(model.maxima(rows), whole)
