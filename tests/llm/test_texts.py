"""Text operators against libraries, brute force and edge cases."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from anagrove.llm import bpe, chat, jaccard, language, packing, shingles, toxicity
from anagrove.llm.word_tokens import ChunkTokenizer
from anagrove.session import materialise

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, piece string"
LONG = "lorem ipsum dolor " * 3000
EDGES = [
    (1, "One two three four five six.", "en", "x"),
    (2, None, None, None),
    (3, "", "en", "x"),
    (4, LONG, "en", None),
    (5, "One two three four five six.", "en", "x"),
    (None, "no id here at all, none", None, "x"),
    (6, "!!! 123 ½ ² ①", "fr", "x"),
    (1, "One two three four five six.", "en", "x"),
]
TEXTS = st.text(alphabet="aAeé ß1\n\t'.,日😀<|endoftext|>re\x1c\u0301", max_size=40)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(EDGES, DOCS)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_chunked_ids_equal_the_library(texts):
    own, library = _chunked(), _library(WORD)
    ids = [np.frombuffer(b, dtype="<u4").tolist() for b in own.encode(texts)]
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in texts]


_HELD = {}


def _library(path):
    return _HELD[path] if path in _HELD else _HELD.setdefault(path, Tokenizer.from_file(path))


def test_each_piece_makes_the_squares_smallest():
    lengths = np.random.default_rng(0).integers(1, 13, 120)
    sequence, offset = packing.place(lengths, 12)
    level: dict[int, int] = {}

    def squares(levels):
        return sum(x * x for x in np.bincount([v for v in levels if v < 12], minlength=12))

    for s, n, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        choices = [squares([*level.values(), s])]
        choices += [squares([v + s * (k == b) for k, v in level.items()]) for b, v in level.items() if v + s <= 12]
        assert level.get(n, 0) == at
        level[n] = at + s
        assert squares(level.values()) == min(choices)
    assert max(level.values()) <= 12


def test_packing_edges(spark, docs):
    rows = packing.pack_documents(docs, WORD, 512).collect()
    assert {r.doc_id for r in rows} == {None, 1, 2, 3, 4, 5, 6}
    whole = np.array(_library(WORD).encode(LONG, add_special_tokens=False).ids + [0], dtype="<u4")
    cut = [(k, a, whole[a : a + 512]) for k, a in enumerate(range(0, len(whole), 512))]
    own = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == 4)
    assert own == [(k, a, len(ids), zlib.crc32(ids.tobytes())) for k, a, ids in cut]
    assert [r.length for r in rows if r.doc_id in (2, 3)] == [1, 1]
    for number in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == number), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    assert packing.pack_documents(docs.limit(0), WORD).count() == 0


def test_sequences_hold_the_ids(spark, docs):
    pieces = materialise(packing.token_pieces(docs, WORD, 512, with_ids=True))
    held = packing.sequences(packing.pack(pieces, 512)).collect()
    assert sum(len(r.ids) for r in held) == sum(r.length for r in pieces.collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_bpe_equals_the_library(texts):
    own, library = bpe.codec(BYTE), _library(BYTE)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids.tolist()) == library.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdehinorst ", min_size=1, max_size=60))
def test_segment_tree_equals_plain_merging(text):
    own = bpe.codec(BYTE)
    plain = [own.of_byte[b] for b in text.encode()]
    ids = list(plain)
    while ranked := [(own.rank[p], i) for i, p in enumerate(zip(plain, plain[1:], strict=False)) if p in own.rank]:
        rank, i = min(ranked)
        plain[i : i + 2] = [own.merged[rank]]
    assert own.merge(ids) == plain


def test_bpe_edges(spark, docs):
    texts = {i: t or "" for i, t, *_ in EDGES}
    rows = bpe.round_trip(docs, BYTE).collect()
    assert len(rows) == len(EDGES)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
    back = bpe.decode(bpe.encode(docs, BYTE), BYTE)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t, *_ in EDGES)
    assert bpe.round_trip(docs.limit(0), BYTE).count() == 0


def test_chat_keeps_turns_and_masks_replies(spark):
    odd = "<|im_end|><|im_start|>assistant ok\\b\\n\\<\\p"
    rows = [
        (1, 0, "system", "s"),
        (1, 1, "user", odd),
        (1, 2, "assistant", odd),
        (1, 3, "user", None),
        (1, 4, "assistant", "é😀"),
        (1, 5, "user", "end"),
        (2, 0, "us\ner<|", "x"),
        (3, 0, "assistant", ""),
        (3, 0, "assistant", ""),
        (None, None, None, None),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    examples = materialise(chat.expand(turns))
    assert examples.filter("conv_id = 1").count() == 3
    found = {r.conv_id: r for r in chat.read_back(examples).collect()}
    for conv in (1, 2, 3, None):
        own = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        said = "".join(f"{r}\n{t}\n" for r, t in own)
        loss = "".join(t for r, t in own if r == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    plan = chat.read_back(chat.expand(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.read_back(chat.expand(turns.limit(0))).count() == 0


def _words(rng, n):
    return [f"w{x}" for x in rng.integers(0, 10**6, n)]


def _near_texts():
    rng = np.random.default_rng(2)
    texts = []
    for words in [_words(rng, 60) for _ in range(6)]:
        for k in range(12):
            own = list(words)
            for at in rng.integers(0, 60, k % 4):
                own[at] = f"n{rng.integers(0, 99)}"
            texts.append(" ".join(own))
    return texts + ["Short Text here.", "short, text HERE", "", None, "!!!", texts[0].upper() + "!"]


@pytest.mark.parametrize("chunk_rows", [512, 8])
def test_join_against_brute_force(spark, chunk_rows):
    texts = _near_texts()
    rows = [(i, t, None, "x") for i, t in enumerate(texts)] + [(None, texts[0], None, "x")]
    sets = [shingles.shingles(t or "") for t in texts]

    def near(a, b):
        both = len(np.intersect1d(a, b))
        return len(a) > 0 and len(b) > 0 and both >= 0.8 * (len(a) + len(b) - both)

    links = {i: {j for j in range(len(texts)) if j != i and near(sets[i], sets[j])} for i in range(len(texts))}
    found = jaccard.similarity_join(spark.createDataFrame(rows, DOCS), chunk_rows=chunk_rows).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert {i: by_id[i].n_links for i in links} == {i: len(n) for i, n in links.items()}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            more = links[todo.pop()] - seen
            seen |= more
            todo.extend(more)
        assert by_id[i].component_id == min(seen) and by_id[i].kept == (min(seen) == i)
        same = [j for j in links if len(sets[i]) and np.array_equal(sets[i], sets[j])]
        assert by_id[i].class_id == min(same, default=i)


def test_join_of_nothing(spark):
    assert jaccard.similarity_join(spark.createDataFrame([], DOCS)).count() == 0


def test_pruning_follows_the_posterior():
    x = (np.arange(200_000) + 0.5) / 200_000
    for n in (32, 64, 128):
        least = jaccard.agreements_needed(0.8, 1e-6, n)

        def chance(m):
            logs = m * np.log(x) + (n - m) * np.log(1 - x)
            weights = np.exp(logs - logs.max())
            return weights[x >= 0.8].sum() / weights.sum()

        assert chance(least) >= 0.99e-6 and chance(least - 1) < 1.01e-6


def test_shingles_dont_depend_on_blocks(monkeypatch):
    text = "Ein Überfluß an Wörtern, 12 und_mehr! " * 40
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "BLOCK", 50)
    assert np.array_equal(whole, shingles.word_hashes(text)) and len(whole) == 40 * 6


def test_toxicity_is_learned_and_ordered(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(400):
        words = _words(rng, 30)
        if i % 5 == 0:
            words[: 1 + i % 7] = ["nasty"] * (1 + i % 7)
        rows.append((i, " ".join(words), "en", "x"))
        if i < 300:
            labels.append((i, int(i % 5 == 0)))
    labels += [(None, 1), (7, None), (9999, 1)]
    docs = spark.createDataFrame(rows + [(r[0] and r[0] + 1000, *r[1:]) for r in EDGES], DOCS)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(found[i].toxic == (i % 5 == 0) for i in range(400))
    assert found[1002].toxic is False and found[1003].expected_severity == found[1002].expected_severity
    assert np.all(np.diff(model.thresholds) > 0)
    assert found[45].expected_severity > found[0].expected_severity  # four nasty words over one
    nothing = toxicity.fit(docs, known.limit(0))
    assert toxicity.score(docs, nothing).filter("toxic").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_language_on_held_out_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(documents)
    held = documents.filter(language.is_held_out(F.col("doc_id")))
    found = language.predict(held, model).join(held, "doc_id")
    assert found.filter("lang = lang_pred").count() >= 0.98 * found.count() > 100
    assert found.filter("score < 0 or score > 1").count() == 0


def test_language_edges(spark, docs):
    model = language.fit(docs)
    found = language.predict(docs, model).collect()
    assert len(found) == len(EDGES)
    assert all(r.lang_pred == "und" and r.score == 0 for r in found if r.doc_id in (2, 3, 6))
    assert all(r.lang_pred != "und" for r in found if r.doc_id in (1, 4, 5))
    nothing = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def test_toxicity_cut_keeps_false_alarms_low():
    p = np.array([0.05] * 98 + [0.2, 0.3] + [0.25, 0.4, 0.9])
    toxic = np.arange(103) >= 100
    assert toxicity.choose_cut(p, toxic, 0.0) == pytest.approx(0.35)
    assert toxicity.choose_cut(p, toxic, 0.005) == pytest.approx(0.225)
    assert toxicity.choose_cut(p[:100], toxic[:100], 0.0) == pytest.approx(0.65)
    assert toxicity.choose_cut(p[:0], toxic[:0]) == 0.5 == toxicity.choose_cut(p[100:], toxic[100:])


def test_ordinal_likelihood_is_at_its_largest():
    """No single weight or threshold can be moved to a likelier model, by sums over grades."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 3, (400, 3)).astype(float)
    grade = np.digitize(x @ [1.0, 0.4, -0.6] + rng.logistic(size=400), [0.5, 1.5, 2.5])
    row, column = np.nonzero(x)
    weights, thresholds = toxicity.fit_ordinal(row, column, x[row, column], grade, 3, 4)

    def loss(p):
        below = 1 / (1 + np.exp(-(p[3:][None, :] - (x @ p[:3])[:, None])))
        cdf = np.concatenate([np.zeros((400, 1)), below, np.ones((400, 1))], axis=1)
        at = np.arange(400)
        return -np.log(cdf[at, grade + 1] - cdf[at, grade]).mean() + toxicity.L2 / 2 * (p[:3] ** 2).sum()

    found = np.concatenate([weights, thresholds])
    for i in range(6):
        for step in (-0.05, 0.05):
            assert loss(found) < loss(found + step * (np.arange(6) == i))


def test_toxicity_on_unseen_labels(spark):
    """Fitted on three quarters of the labels, measured on the rest; scores equal a plain sum over features."""
    sf = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    given = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 0
    model = toxicity.fit(documents, labels.filter(given))
    unseen = labels.filter(~given).join(documents, "doc_id")
    rows = toxicity.score(unseen, model).join(unseen.select("doc_id", F.col("toxic").alias("label"), "text"), "doc_id").collect()
    assert np.mean([r.toxic for r in rows if r.label]) > 0.65
    assert np.mean([not r.toxic for r in rows if not r.label]) > 0.99
    for r in rows[:200]:
        words = toxicity.words_of(r.text or "")
        every = [f for w in words for f in toxicity.features_of(w)]
        score = sum(np.log1p(every.count(f)) * model.weights.get(f, 0.0) for f in set(every))
        beyond = 1 / (1 + np.exp(-(score - model.thresholds)))
        assert r.expected_severity == pytest.approx(beyond.sum()) and r.toxic_probability == pytest.approx(beyond[0])
        assert r.grade == np.argmax(-np.diff([1, *beyond, 0]))


def test_fits_stay_bounded_for_a_hot_id(spark):
    hot = spark.range(1_000).select(F.lit(8).cast("long").alias("doc_id"), F.concat(F.lit("ein text "), "id").alias("text"), F.lit("de").alias("lang"))
    rest = spark.range(60).select((F.col("id") + 100).alias("doc_id"), F.lit("un texte autre").alias("text"), F.lit("fr").alias("lang"))
    documents = hot.union(rest)
    labels = documents.select("doc_id", F.when(F.col("doc_id") == 8, 1).otherwise(0).alias("toxic"))
    assert toxicity.fit(documents, labels).thresholds.size
    assert language.fit(documents).families == [["de"], ["fr"]]


def test_language_decides_family_then_pairs():
    """Cached word margins equal plain n-gram frequencies; the decision equals votes counted one by one."""
    rng = np.random.default_rng(6)
    families = [["de", "en", "nl"], ["es", "fr"]]
    pairs = [("de", "en"), ("de", "nl"), ("en", "nl"), ("es", "fr")]
    weights = rng.normal(size=(language.BUCKETS, 6))
    model = language.LanguageModel(families, pairs, weights, rng.normal(size=6) * 0.1)
    cached = language._WordMargins(weights)
    for text in ["Ein Wort ein WORT", "déjà vu ½ x²y", "a", "the the the quick", "ñandú ÜBER größe"]:
        words = language.words_of(text)
        grams = [g for w in words for g in language.grams_of(w)]
        plain = sum(weights[language.bucket_of(g)] for g in grams) / len(grams)
        assert np.allclose(cached.of(words), plain)
        margins = plain + model.offsets
        own = families[int(margins[1] > margins[0])]
        p = 1 / (1 + np.exp(-4 * margins))
        votes = {x: sum((p[2 + k] >= 0.5) == (x == a) for k, (a, b) in enumerate(pairs) if x in (a, b)) for x in own}
        names, scores = model.decide(margins[None, :])
        assert votes[names[0]] == max(votes.values()) and 0 <= scores[0] <= 1
    assert language.words_of("½ ² ①") == [] and language.words_of("a½b c") == ["a", "b", "c"]


WORDS = st.lists(st.sampled_from([",", ".", "don't", "ab,", "Öl.", "..", "x1.", "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|startoftext|>", "Hi", "hi", " ", "\n", "é", "a\n b"]), max_size=8)


@settings(max_examples=100, deadline=None)
@given(WORDS)
def test_special_strings_are_the_library_s_own(words):
    text = "".join(words)
    own, library = bpe.codec(BYTE), _library(BYTE)
    assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    chunked = np.frombuffer(_chunked().encode([text])[0], dtype="<u4").tolist()
    assert chunked == _library(WORD).encode(text, add_special_tokens=False).ids


def _chunked():
    return _HELD["chunked"] if "chunked" in _HELD else _HELD.setdefault("chunked", ChunkTokenizer(WORD, max_cached=20))
