import hashlib
import math
import random
import tracemalloc
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidegrid.llm import bpe_codec, chat, decontaminate, language, quality, token_counts, toxicity, vocabulary

SCHEMA = "doc_id long, text string"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def strange_texts():
    rng = random.Random(6)
    letters = "abcdefg hijklm  \n\t'sS'tİΣσς<|endoftext|>éÀ́ß½²٣日本🙂\u0085  　\x1c\x1f0123$$%&,.!?aaaa"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    # characters on which Unicode versions differ, and some beside them
    newer = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c in vocabulary.SMALL or c % 7 == 0 and vocabulary.LATER.match(chr(c)))]
    out += [f"a{x}b {x}{x}1 \t{x}\n x" for x in newer]
    return [*out, "a" * 5000, "ab" * 2000, "$" * 2000, " " * 3000, "the" * 2000, *("".join(rng.choice("etaoinshr") for _ in range(3000)) for _ in range(3))]


def cut(rng, text, most):
    """A text in pieces of up to ``most`` characters."""
    at = 0
    while at < len(text):
        size = rng.randint(1, most)
        yield text[at : at + size]
        at += size


def long_texts():
    """Texts in which words, white space and special strings are longer than a small piece."""
    rng = random.Random(16)
    out = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(1, 8)):
            kind = rng.choice(["aé", "12½", " ", " \n\u3000", "$.'", "'s", "日本", "e\u0301À", "\u1112\u1161\u11ab", "abc d", "<|endoftext|>", "\x1c ", "\U0001E6C0x"])
            parts.append("".join(rng.choice(kind) for _ in range(rng.choice([1, 3, 40, 300, 900]))) if rng.random() < 0.8 else kind * rng.randint(1, 40))
        out.append("".join(parts))
    return out


def test_transducer_equals_library(monkeypatch):
    library, source = Tokenizer.from_file(BYTES), open(BYTES).read()
    coder, rng = bpe_codec.transducer(source), random.Random(1)
    for small in (False, True):
        if small:
            monkeypatch.setattr(vocabulary, "PIECE", 150)
        for text in [*long_texts(), *strange_texts()[:: 7 if small else 1]]:
            ids = array("I", b"".join(coder.encode(cut(rng, text, 200) if small else [text]))).tolist()
            assert ids == library.encode(text, add_special_tokens=False).ids
            decoder = bpe_codec.Decoder(coder.vocab)
            assert "".join([*(decoder.feed(array("I", [x]).tobytes()) for x in ids), decoder.feed(b"", True)]) == library.decode(ids, skip_special_tokens=False)


def test_stream_is_independent_of_parts():
    coder = bpe_codec.transducer(open(BYTES).read())
    rng = random.Random(2)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(20_000)).encode()
    assert list(coder.stream([word[:4000]])) == coder.merged(coder.vocab.symbols(word[:4000]))
    assert list(coder.stream([word[i : i + 777] for i in range(0, len(word), 777)])) == list(coder.stream([word]))


@pytest.mark.parametrize(("path", "kind"), [(BYTES, bpe_codec.Transducer), (WORDS, token_counts.Counter)])
def test_memory_is_bounded_over_a_long_text(monkeypatch, path, kind):
    """50 MB of words, and long words of each kind of character: symbols and characters held stay those of a window and a piece."""
    coder = kind(vocabulary.Vocabulary(open(path).read()))
    most, settle, words = {"symbols": 0, "characters": 0}, coder.settle, coder.vocab.words

    def settled(symbols, stable):
        most["symbols"] = max(most["symbols"], len(symbols))
        return settle(symbols, stable)

    def seen(chunks):
        for some, part, ended, special in words(chunks):
            most["characters"] = max(most["characters"], sum(map(len, some)), len(part))
            yield some, part, ended, special

    monkeypatch.setattr(coder, "settle", settled)
    monkeypatch.setattr(coder.vocab, "words", seen)
    rng = random.Random(5)
    piece = "".join(rng.choice(["the ", "of ", "Wort ", "année, ", "x1 ", "... ", "\n"]) for _ in range(12_000))
    texts = [(piece for _ in range(50_000_000 // len(piece.encode()))), *((x * 50_000 for _ in range(6)) for x in ("ab", " ", "$", "é"))]
    for text in texts:
        n = sum(len(x) // 4 for x in coder.encode(text)) if kind is bpe_codec.Transducer else coder.of(text)
        assert n > 10_000 or kind is token_counts.Counter
    assert most["symbols"] <= 2 * coder.vocab.window and most["characters"] <= 3 * vocabulary.PIECE
    small = vocabulary.Kept(len, most=20_000)
    for i in range(10_000):
        assert small[f"{i:06d}"] == 6 and small["x" * 65] == 65
    assert len(small) * 230 <= 20_000


def test_counts_equal_library(monkeypatch):
    library, rng = Tokenizer.from_file(WORDS), random.Random(3)
    counts = token_counts.Counter(vocabulary.Vocabulary(open(WORDS).read()))
    for small in (False, True):
        if small:
            monkeypatch.setattr(vocabulary, "PIECE", 150)
        for text in [*long_texts(), *strange_texts()[:: 7 if small else 1]]:
            assert counts.of(cut(rng, text, 200) if small else [text]) == len(library.encode(text, add_special_tokens=False).ids)


def test_tokens_of_odd_rows(odd, empty):
    library = Tokenizer.from_file(BYTES)
    texts = {(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in bpe_codec.digests(odd, BYTES).collect()}
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        if i != 2:
            assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
            assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    back = bpe_codec.decoded(bpe_codec.encoded(odd, BYTES), BYTES).collect()
    assert len(back) == odd.count() and all(r["decoded"] == (r["text"] or "") for r in back)
    counts = {r["doc_id"]: r for r in token_counts.counted(odd, WORDS, limit=1000).collect()}
    assert counts[3]["n_tokens"] == counts[4]["n_bytes"] == 0 and counts[8]["n_bytes"] == 30_000 and counts[8]["over_limit"]
    assert bpe_codec.digests(empty, BYTES).count() == token_counts.counted(empty, WORDS).count() == 0


def windows(docs, items, width=5, percent=80):
    from collections import Counter

    def grams(words, n):
        return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))

    out = {}
    for d, text in docs:
        words = (text or "").lower().split()
        for i, item in items:
            own = (item or "").lower().split()
            n = min(width, len(own))
            for s in range(len(words) - len(own) + 1 if own else 0):
                a, b = grams(words[s : s + len(own)], n), grams(own, n)
                common = sum((a & b).values())
                union = sum((a | b).values())
                if 100 * common >= percent * union:
                    out[d, i] = max(out.get((d, i), (0, 0)), (common / union, -s))
    return {k: (round(v[0], 9), -v[1]) for k, v in out.items()}


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([2, 4, 12, 30, 55, 60])))) for i in range(12)] + [(12, ""), (13, None), (14, "go go go go go go go go go go")]
    docs = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        if i % 2:
            own = (items[rng.randrange(15)][1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if own:
                    own[rng.randrange(len(own))] = rng.choice(words)
            at = rng.randint(0, len(text))
            text[at:at] = [x.upper() for x in own] if i % 3 else own
        docs.append((i, " ".join(text)))
    docs += [(100, None), (101, ""), (102, "go " * 50)]
    got = decontaminate.matches(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["start_word"]) for r in got}
    expected = windows(docs, items)
    assert len(expected) > 15 and found == expected


def test_decontamination_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "Alpha  beta gamma DELTA."), (2, None)], "item_id long, text string")
    clean = decontaminate.clean(odd, items)
    assert clean.columns == odd.columns and not {1, 2, 10} & {r["doc_id"] for r in clean.collect()} and clean.count() == odd.count() - 4
    assert decontaminate.clean(odd, items.limit(0)).count() == odd.count() and decontaminate.matches(empty, items).count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    return read("documents"), read("labels")


def held_out(scores, labels, column):
    rows = scores.join(labels.filter(f"{column} IS NOT NULL"), "doc_id").filter("held_out").select("score", "predicted", column).collect()
    return [(r["score"], r["predicted"], r[column]) for r in rows]


def test_toxicity_held_out(tables):
    rows = held_out(toxicity.scored(*tables), tables[1], "toxic")
    toxic = [p for _, p, y in rows if y]
    assert len(toxic) > 30 and sum(toxic) / len(toxic) > 0.9 and sum(p for _, p, y in rows if not y) <= 0.01 * len(rows)


def test_quality_held_out(tables):
    rows = held_out(quality.scored(*tables), tables[1], "quality")
    assert sum(p == y for _, p, y in rows) / len(rows) > 0.98


def test_language_held_out(tables):
    rows = language.identified(tables[0]).join(tables[0].select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 3000 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_classifiers_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (6, None, 1), (None, 0, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    for scores in (toxicity.scored(odd, labels), toxicity.scored(odd, labels.limit(0)), quality.scored(odd, labels), quality.scored(odd, labels.limit(0))):
        rows = scores.collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    got = {r["doc_id"]: r for r in language.identified(odd).collect()}
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == got[7]["lang_pred"] == "und" and got[3]["score"] == 0
    assert toxicity.scored(empty, labels).count() == quality.scored(empty, labels).count() == language.identified(empty).count() == 0
    assert toxicity.clean(odd, labels.limit(0)).columns == odd.columns and toxicity.clean(empty, labels).count() == 0


def objective(x, y, weight, swaps, w, bias, l1, strength):
    p = 1 / (1 + np.exp(-(x @ w + bias)))
    loss = -(weight / weight.sum()) @ (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))
    share = np.array([n for *_, n in swaps]) / max(1, sum(n for *_, n in swaps))
    return loss + l1 * np.abs(w).sum() + strength * sum(s * (w[new].sum() - w[gone].sum()) ** 2 for s, (gone, new, _) in zip(share, swaps))


def test_toxicity_fit_reaches_the_minimum():
    """Against plain steps down the gradient of the same sum, many and small."""
    rng = np.random.default_rng(4)
    x = (rng.random((80, 12)) < 0.4).astype(float)
    y = (x[:, 0] + x[:, 1] - x[:, 2] + 0.5 * rng.standard_normal(80) > 0.6).astype(float)
    weight, swaps, l1, strength = np.where(y == 1, 4.0, 1.0), [(np.array([0]), np.array([3]), 5), (np.array([1, 4]), np.array([5]), 2)], 3e-4, 1.0
    found = toxicity.fit([np.flatnonzero(r) for r in x], y, weight, swaps, l1=l1, counterfactual=strength)
    w = np.zeros(12)
    w[found["at"]] = found["w"]
    v, bias = np.zeros(12), 0.0
    share = [n / 7 for *_, n in swaps]
    for _ in range(60_000):
        g = weight / weight.sum() * (1 / (1 + np.exp(-(x @ v + bias))) - y)
        grad = x.T @ g
        for s, (gone, new, _) in zip(share, swaps):
            d = v[new].sum() - v[gone].sum()
            grad[new] += 2 * strength * s * d
            grad[gone] -= 2 * strength * s * d
        v -= 0.1 * grad
        v = np.sign(v) * np.maximum(np.abs(v) - 0.1 * l1, 0)
        bias -= 0.1 * g.sum()
    least = objective(x, y, weight, swaps, v, bias, l1, strength)
    assert objective(x, y, weight, swaps, w, found["bias"], l1, strength) <= least * 1.02 + 1e-4


def test_swaps_are_those_of_sentences():
    """All terms of all groups, beside punctuation too, with the features of the whole sentences before and after."""
    terms = toxicity.others()
    assert set(terms["muslim"]) >= {"christian", "jewish", "hindu", "buddhist", "atheist", "christ", "jude"} and terms["he"] == ["she"]
    text = "Is he, she? No woman; \"Er\" geht! elle"
    pairs = set(toxicity.sentences(text, terms))
    assert {("is he, she", "is she, she"), ("is he, she", "is he, he"), (' no woman; "er" geht', ' no man; "er" geht'), (' no woman; "er" geht', ' no woman; "sie" geht'), (" elle", " il")} == pairs
    found = [(set(a.tolist()), set(b.tolist())) for a, b in toxicity.swaps(pa.array([text, None]))]
    sets = lambda x: set(next(iter(toxicity.presence(pa.array([x])))).tolist())
    assert sorted(map(sorted, (a | b for a, b in found))) == sorted(map(sorted, (sets(x) ^ sets(y) for x, y in toxicity.sentences(text, terms))))


def test_counterfactual_term_spares_neutral_mentions(spark):
    """Where toxic documents mostly name some groups, neutral texts that name them are false alarms without the term."""
    rng = random.Random(1)
    plain = ["house", "river", "walked", "market", "letter", "garden", "music", "winter", "teacher", "bridge", "window", "coffee"]
    named, counterparts, insults = ["women", "muslim", "black", "gay"], ["men", "christian", "white", "straight"], ["scum", "vermin", "filthy", "disgusting"]
    text = lambda more: " ".join(rng.sample(plain, 5) + more) + "."
    toxic = [text([rng.choice(insults)] * (rng.random() < 0.8) + [rng.choice(named)]) for _ in range(300)]
    fine = [text([rng.choice(counterparts)] if rng.random() < 0.5 else []) for _ in range(600)]
    neutral, insulting = [text([rng.choice(named)]) for _ in range(200)], [text([rng.choice(insults), rng.choice(counterparts)]) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate([*toxic, *fine, *neutral, *insulting])), SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(900)], "doc_id long, toxic int")
    alarms = {}
    for strength in (0.0, 1.0):
        got = {r["doc_id"]: r["predicted"] for r in toxicity.scored(docs, labels, counterfactual=strength).collect()}
        alarms[strength] = sum(got[i] for i in range(900, 1100)) / 200
    assert alarms[0.0] > 0.8 and alarms[1.0] < 0.25 and sum(got[i] for i in range(1100, 1300)) > 190


def test_quality_votes_equal_brute_force():
    """Trigrams, projection and votes of all neighbours as near as the last, text by text."""
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcde fgh") for _ in range(rng.randint(0, 200))) for _ in range(60)]
    column = pa.array([*texts, None, "ab", texts[3]])
    counts = np.concatenate(list(quality.counted(column)))
    for row, text in zip(counts, column.to_pylist()):
        own = np.zeros(quality.BUCKETS)
        raw = (text or "").encode()
        for i in range(len(raw) - 2):
            own[((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 2654435769 % 2**32) >> 20] += 1
        assert (row[: quality.BUCKETS] == own).all()
    y = np.array([rng.randint(0, 1) for _ in range(40)] + [1, 0])
    train = np.concatenate([counts[:40], counts[:2]])  # two vectors twice
    idf = quality.sampling.idf_of(np.count_nonzero(counts[:, : quality.BUCKETS], axis=0), len(counts))
    model = quality.fit(train, y, {0: 0.7, 1: 0.3}, idf)
    got = quality.vote(model, counts, neighbours=5)
    for row, score in zip(counts, got):
        x = np.log1p(row[: quality.BUCKETS]) * idf
        x = np.concatenate([x / (np.linalg.norm(x) or 1), row[quality.BUCKETS :] / quality.SHARE]) @ model["basis"]
        x /= np.linalg.norm(x) or 1
        cosines = [float(x @ v) for v in model["vectors"]]
        last = sorted(cosines)[-5]
        votes = [(math.exp(8 * c) * w, label) for c, w, label in zip(cosines, model["vote"], y) if c >= last - 1e-5]
        expected = sum(v for v, label in votes if label) / sum(v for v, _ in votes) if row.any() else 0.3
        assert abs(score - expected) < 1e-3


def test_language_ngrams_and_steps_equal_brute_force():
    """Characters, not bytes; follow-the-regularised-leader with one weight at a time."""
    texts = ["Привет, мир", "ΑΒΓ abc", "日本語", "", None, "aÄ", "x"]
    blocks = np.concatenate(list(language.counted(pa.array(texts))))
    for row, text in zip(blocks, texts):
        own, letters = np.zeros(1 << language.BITS), [ord(c) for c in (text or "").lower()]
        for n in (1, 2, 3):
            for i in range(len(letters) - n + 1):
                x = 0
                for c in letters[i : i + n]:
                    x = (x + c + 1) * 0x9E3779B97F4A7C15 % 2**64
                own[x >> 64 - language.BITS] += 1
        assert (row == own).all()
    rng = np.random.default_rng(2)
    counts, y = rng.integers(0, 3, (30, 6)).astype(np.float32), rng.integers(0, 3, 30)
    idf = np.ones(6, np.float32)
    got = language.fit(counts, y, 3, idf, epochs=2, batch=4)
    x = np.log1p(counts)
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    x = np.hstack([x, np.ones((30, 1))])
    order = np.random.Generator(np.random.PCG64(3))
    train = order.permutation(30)[6:]
    z, n = np.zeros((7, 3)), np.zeros((7, 3))

    def weight(i, c):
        if abs(z[i, c]) <= 0.02:
            return 0.0
        return -(z[i, c] - math.copysign(0.02, z[i, c])) / ((1.0 + math.sqrt(n[i, c])) / 2.0 + 0.01)

    for _ in range(2):
        order.shuffle(train)
        for at in range(0, len(train), 4):
            own = train[at : at + 4]
            w = np.array([[weight(i, c) for c in range(3)] for i in range(7)])
            grad = np.zeros((7, 3))
            for r in own:
                e = np.exp(x[r] @ w - (x[r] @ w).max())
                grad += np.outer(x[r], e / e.sum() - np.eye(3)[y[r]]) / len(own)
            for i in range(7):
                for c in range(3):
                    g = grad[i, c]
                    z[i, c] += g - (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / 2.0 * w[i, c]
                    n[i, c] += g * g
    expected = np.array([[weight(i, c) for c in range(3)] for i in range(7)])
    assert np.abs(np.vstack([got["w"], got["bias"]]) - expected).max() < 1e-3


def test_language_sample_is_held_sparse(spark):
    """The driver doesn't hold the sample's counts as a dense table, and learns what it learnt from one."""
    rng = random.Random(5)
    data = [(i, " ".join(rng.choices(["ab", "bc", "cad", "dab"] if i % 2 else ["xy", "yz", "ab", "zoy"], k=20)), f"l{i % 2}") for i in range(1_200)]
    learnt = [r for r in data if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    docs = spark.createDataFrame(data, SCHEMA + ", lang string")
    language.session.workers_see(spark)
    tracemalloc.start()
    try:
        found = language.model_of(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < len(learnt) * (4 << language.BITS) / 2
    dense = np.concatenate(list(language.counted(pa.array([r[1] for r in learnt]))))
    idf = language.sampling.idf_of(np.count_nonzero(dense, axis=0), len(dense))
    want = language.fit(dense, np.array([r[0] % 2 for r in learnt]), 2, idf)
    np.testing.assert_allclose(found["w"], want["w"], atol=1e-6)
    assert found["temperature"] == pytest.approx(want["temperature"])


def test_language_of_another_script(spark):
    """Two languages in Cyrillic letters that differ in their words only, from every value of lang, also rare ones."""
    rng = random.Random(13)
    words = {"ru": "что это как его все она так было тогда человек время".split(), "uk": "що це як його все вона так було тоді людина час".split(), "el": "και το να του της με που".split()}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(4, 30))), lang) for i in range(900) for lang in [rng.choice(["ru", "uk", "uk", "ru", "ru", "el"])]]
    rows += [(1000 + i, "zzz qqq", f"l{i % 250}") for i in range(1000)]
    docs = spark.createDataFrame(rows, SCHEMA + ", lang string")
    got = {r["doc_id"]: r for r in language.identified(docs).collect()}
    held = [(got[i]["lang_pred"], lang) for i, _, lang in rows if i < 900 and got[i]["held_out"]]
    assert len(held) > 200 and sum(a == b for a, b in held) / len(held) > 0.97


def test_frequencies_cover_all_rows(spark):
    texts = spark.createDataFrame([(f"abc{i % 3}",) for i in range(3000)] + [(None,), ("",)], "text string").repartition(5)
    found, n = quality.sampling.document_frequencies(texts, quality.counted, quality.BUCKETS)
    assert n == 3002 and found.max() == 3000 and found.sum() == 3000 + 3000


def test_sample_holds_every_value(spark):
    rows = spark.createDataFrame([(i, f"v{i % 3000}") for i in range(6000)] + [(i, "big") for i in range(6000, 20_000)], "doc_id long, lang string")
    sample, counts = quality.sampling.balanced(rows, "lang", 100)
    sizes = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert len(counts) == len(sizes) == 3001 and 50 < sizes.pop("big") < 160 and set(sizes.values()) == {2}


def test_candidates_of_decontamination_are_few(spark):
    """Of all pairs of a window of random words and an item, hardly any reach the fingerprints, though items hold a third of all pairs of words."""
    rng = random.Random(18)
    words = [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = spark.createDataFrame([(i, draw(30)) for i in range(50)] + [(None, draw(30))], "item_id long, text string")
    docs = spark.createDataFrame([(i, draw(200)) for i in range(200)], SCHEMA)
    own = decontaminate.items_of(items, 2)
    found = decontaminate.candidates(docs, own, 2, 80, True, 1000)
    pairs = found.selectExpr("sum(size(items))").first()[0] or 0
    assert pairs < 0.01 * 200 * 171 * 51, pairs


#: Costs and legal turns of the task, apart from the module's tables.
INSERT, RELABEL, NAME, MERGE = 3, 2, 1, 1


def follows(before, role):
    return role in {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}[before]


def cheapest(roles):
    """The least cost over all repairs, enumerated one by one: every given turn is kept, relabelled or merged, empty turns stand between."""
    best = [10**9]

    def go(i, last, cost, given):
        """``last``: the role of the last turn; ``given``: whether that turn was given."""
        if cost >= best[0]:
            return
        if i == len(roles) and last in ("start", "assistant"):
            best[0] = cost
            return
        for role in ("system", "user", "assistant"):
            if follows(last, role):
                if i < len(roles):
                    go(i + 1, role, cost + (0 if roles[i] == role else NAME if roles[i] is None else RELABEL), True)
                go(i, role, cost + INSERT, False)
        if i < len(roles) and given:
            go(i + 1, last, cost + MERGE + (0 if roles[i] == last else NAME if roles[i] is None else RELABEL), True)

    go(0, "start", 0, False)
    return best[0]


def legal(roles):
    last = "start"
    for role in roles:
        if not follows(last, role):
            return False
        last = role
    return last in ("start", "assistant")


def test_repair_is_cheapest_and_legal():
    rng = random.Random(3)
    names = {None: None, 1: "system", 2: "user", 3: "assistant"}
    for _ in range(300):
        roles = [rng.choice([None, 1, 2, 3]) for _ in range(rng.randint(1, 7))]
        moves, tail = chat.repair(roles)
        out, cost = [], INSERT * len(tail)
        for role, (action, to, path) in zip(roles, moves):
            cost += INSERT * len(path) + (MERGE if action == "merge" else 0) + (0 if role == to else NAME if role is None else RELABEL)
            out += [*path] + [to] * (action != "merge")
        assert legal([names[x] for x in [*out, *tail]]) and cost == cheapest([names[x] for x in roles])


def test_chat_in_chunks_costs_the_same(spark):
    """Conversations over many chunks, with columns of clashing names: the repair of each is legal and costs what one without chunks does."""
    rng = random.Random(5)
    names = ["user", "Assistant ", "system", None, "tool", "human"]
    known = {"user": "user", "Assistant ": "assistant", "system": "system", "human": "user"}
    rows = [(c, t, rng.choice(names), f"text {t}") for c, n in ((1, 40), (2, 3), (None, 7), (3, 1), (5, 9)) for t in range(n)] + [(4, None, "user", None), (4, 1, "user", "")] * 2
    rows = [(*r, 1, "x", 2, "y", 3) for r in rows]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, chunk int, piece string, place int, action string, entry int").repartition(3)

    def cost_of(own):
        cost = sum(INSERT * len(r["inserted"]) + (MERGE if r["action"] == "merge" else 0) for r in own)
        return cost + sum(0 if known.get(r["given"]) == r["role"] else NAME if known.get(r["given"]) is None else RELABEL for r in own)

    costs = {}
    for size in (4096, 4):
        got = chat.formatted(turns, chunk=size).orderBy("conv_id", "chunk", "place").collect()
        assert len(got) == len(rows) and (size > 4 or len({r["chunk"] for r in got}) > 10)
        for conv in (1, 2, None, 3, 4, 5):
            own = [r for r in got if r["conv_id"] == conv]
            text = "".join(r["piece"] for r in own)
            assert legal([x.split("\n")[0] for x in text.split("<|im_start|>")[1:]]) and text.count("<|im_start|>") == text.count("<|im_end|>")
            costs[size, conv] = cost_of(own)
            if len(own) < 8:
                assert costs[size, conv] == cheapest([known.get(r["given"]) for r in own])
    assert all(costs[4, c] == costs[4096, c] for _, c in costs)
    assert chat.formatted(turns.limit(0)).count() == 0
