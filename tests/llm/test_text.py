"""Decontamination, token counts, language model, classifier, chat and URL rules."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from compare import connect, differences
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer, models, normalizers

from brassledger.llm import chat, decontaminate, ppm, queries, token_counts, url_rules
from brassledger.llm import quality_cnn as cnn
from brassledger.session import ship_package

ODD = [None, "", "  two  spaces \n\n line ", "Ünïcode ▁mark", "日本語", "same", "same", "x" * 3000, "w " * 4000, "\n", "a\nb", " lead"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, columns with clashing names."""
    rows = [(None if i == 4 else i // 2, t, 1, "x") for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, score int, n_tokens string").repartition(3)


# ---------------------------------------------------------------- oracles
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, small_dir, name):
    assert differences(queries.queries()[name](spark, small_dir), connect(small_dir), queries.oracle_sql()[name]) == []


# ---------------------------------------------------------------- decontamination
def edits_by_hand(item, window):
    row = list(range(len(window) + 1))
    for i, a in enumerate(item, 1):
        fresh = [i]
        for j, b in enumerate(window, 1):
            fresh.append(min(row[j] + 1, fresh[-1] + 1, row[j - 1] + (a != b)))
        row = fresh
    return min(row)


@pytest.mark.parametrize("seed", range(20))
def test_edit_distance(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(0, 15))
    least = edits_by_hand(a.tolist(), b.tolist())
    assert decontaminate.within(a, b, 99) == least
    assert decontaminate.within(a, b, least) == least and (least == 0 or decontaminate.within(a, b, least - 1) is None)


def edited(rng, words, vocabulary, edits):
    words = list(words)
    for _ in range(edits):
        at, kind = int(rng.integers(0, len(words))), rng.integers(0, 3)
        if kind == 0:
            words[at] = str(rng.choice(vocabulary))
        elif kind == 1:
            words.insert(at, str(rng.choice(vocabulary)))
        else:
            del words[at]
    return words


@pytest.fixture(scope="module")
def planted():
    """Items, and documents with edited copies of them among words of the same vocabulary."""
    rng = np.random.default_rng(4)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, rng.choice(vocabulary, rng.integers(8, 60)).tolist()) for i in range(40)]
    docs = []
    for n in range(150):
        k = int(rng.integers(0, 40))
        copy = edited(rng, items[k][1], vocabulary, int(rng.integers(0, int(0.2 * len(items[k][1])) + 1)))
        fill = [rng.choice(vocabulary, rng.integers(0, 50)).tolist() for _ in range(2)]
        docs.append((n, [*fill[0], *copy, *fill[1]] if n % 3 else fill[0] + fill[1]))
    return items, docs


def test_recall_against_brute_force(spark, planted):
    items, docs = planted
    exact, number = set(), {f"v{i}": i for i in range(300)}
    for d, words in docs:
        for i, item in items:
            most = int(0.2 * len(item))
            item, known = np.array([number[w] for w in item]), np.array([number[w] for w in words])
            if any(decontaminate.within(item, known[s : s + len(item) + most], most) is not None for s in range(len(words))):
                exact.add((d, i))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    df = spark.createDataFrame([(d, ", ".join(w).upper()) for d, w in docs], "doc_id long, text string").repartition(3)
    leaks = decontaminate.find_leaks(df, bench).collect()
    found = {(r.doc_id, r.item_id) for r in leaks}
    assert found <= exact and len(found) >= 0.97 * len(exact) and len(exact) >= 80
    by = dict(docs)
    for r in leaks:
        item = items[r.item_id][1]
        window = by[r.doc_id][r.first_word : r.first_word + len(item) + int(0.2 * len(item))]
        assert r.edits == edits_by_hand(item, window) and r.item_words == len(item)
    clean = decontaminate.keep_clean(df, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in found}


def edited_as(rng, kind, words, vocabulary, edits):
    words = list(words)
    for _ in range(edits):
        at, how = int(rng.integers(0, len(words))), kind
        if kind == "mixed":
            how = str(rng.choice(["replace", "insert", "delete"]))
        if how == "replace":
            words[at] = str(rng.choice(vocabulary))
        elif how == "insert":
            words.insert(at, str(rng.choice(vocabulary)))
        else:
            del words[at]
    return words


def recall_at_full_budget(n, kind, trials):
    rng = np.random.default_rng(n)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, rng.choice(vocabulary, n).tolist()) for i in range(trials)]
    around = lambda: rng.choice(vocabulary, 20).tolist()
    docs = [[*around(), *edited_as(rng, kind, w, vocabulary, int(0.2 * n)), *around()] for _, w in items]
    index = decontaminate.Index([(i, " ".join(w)) for i, w in items], 0.2)
    found = {(t, index.items[k][0]) for t, k, _, _ in index.search([" ".join(w) for w in docs])}
    return sum((i, i) in found for i in range(trials)) / trials


@pytest.mark.parametrize("kind", ["mixed", "insert", "delete", "replace"])
@pytest.mark.parametrize("n", [5, 10, 12, 13, 40, 100, 200, 300])
def test_recall_at_the_full_budget_by_length(n, kind):
    recall = recall_at_full_budget(n, kind, 60)
    assert recall >= 0.99


@pytest.mark.parametrize("seed, cells", [(0, 1 << 18), (1, 300), (2, 300)])
def test_longer_items_equal_brute_force(monkeypatch, seed, cells):
    """Few words, so that much is alike, and pieces cut small: every place, with its least edits and first word."""
    monkeypatch.setattr(decontaminate, "CELLS", cells)
    rng = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [rng.choice(vocabulary, rng.integers(13, 30)).tolist() for _ in range(6)]
    docs = [[]]
    for n in range(12):
        copy = edited(rng, items[n % 6], vocabulary, int(rng.integers(0, 6)))
        docs.append([*rng.choice(vocabulary, rng.integers(0, 30)).tolist(), *copy, *rng.choice(vocabulary, 9).tolist()])
    index = decontaminate.Index([(i, " ".join(w)) for i, w in enumerate(items)], 0.2)
    found = {(t, index.items[k][0]): (e, s) for t, k, e, s in index.search([" ".join(w) for w in docs])}
    expected = {}
    for t, words in enumerate(docs):
        for i, item in enumerate(items):
            most = int(0.2 * len(item))
            at = [(edits_by_hand(item, words[s : s + len(item) + most]), s) for s, w in enumerate(words) if w in item]
            if min(at, default=(most + 1,))[0] <= most:
                expected[t, i] = min(at)
    assert found == expected and len(found) >= 6


def test_nothing_is_reported_that_no_bucket_named(monkeypatch, planted):
    """Every reported item was a candidate of the walks; without candidates nothing is found."""
    items, docs = planted
    index = decontaminate.Index([(i, " ".join(w)) for i, w in items])
    named, walk = set(), decontaminate.Walks.candidates

    def watched(self, *given):
        for place, label in walk(self, *given):
            pieces = next(p for c in index.classes for p in c.lengths if self in p.walks)
            named.update(pieces.members[label // pieces.count].tolist())
            yield place, label

    monkeypatch.setattr(decontaminate.Walks, "candidates", watched)
    found = index.search([" ".join(w) for _, w in docs])
    assert len(found) >= 80 and {k for _, k, _, _ in found} <= named
    monkeypatch.setattr(decontaminate.Walks, "candidates", lambda self, *given: iter(()))
    assert index.search([" ".join(w) for _, w in docs]) == []


def test_short_items_and_scripts_without_blanks():
    items = [(0, "alpha"), (1, "alpha beta gamma"), (2, "\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059\u3002\u9577\u3044"), (3, "\u0e2a\u0e27\u0e31\u0e2a"), (4, "!!")]
    index = decontaminate.Index(items)
    texts = ["x alpha y", "alpha beta, Gamma", "beta gamma", "\u3053\u308c\u306f\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059\u9577\u3044 x", "\u0e2a\u0e27\u0e31\u0e2a\u0e14"]
    assert {(t, index.items[k][0]) for t, k, _, _ in index.search(texts)} == {(0, 0), (1, 0), (1, 1), (3, 2), (4, 3)}


def test_shards_find_the_same(spark, planted, monkeypatch):
    items, docs = planted
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    df = spark.createDataFrame([(d, " ".join(items[d][1])) for d in range(40)], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 300)
    found = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.find_leaks(df, bench).collect()}
    assert {(i, i, 0) for i in range(40)} <= found  # exact copies always
    assert decontaminate.keep_clean(df, bench).count() == 0
    plan = decontaminate.keep_clean(df, bench)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan  # passes are written one after the other, no worker opens two shards


def test_odd_benchmarks_and_documents(spark, odd):
    bench = [(1, None), (2, ""), (3, "too short"), (None, "a b c d e"), (4, "a b c d e")]
    bench = spark.createDataFrame([(*b, 1, "x") for b in bench], "item_id long, text string, doc_id int, edits string")
    assert decontaminate.find_leaks(odd, bench).count() == 0
    hit = spark.createDataFrame([(None, "x A, b; c d e"), (7, "x A, b; c d e")], "doc_id long, text string")
    found = decontaminate.find_leaks(hit, bench).collect()
    assert sorted([(r.doc_id, r.item_id, r.edits, r.first_word) for r in found], key=str) == sorted(
        [(d, i, 0, 1) for d in (None, 7) for i in (None, 4)], key=str
    )
    assert decontaminate.find_leaks(odd, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(odd.limit(0), bench).count() == 0
    assert decontaminate.keep_clean(odd, bench.limit(0)).count() == len(ODD)


# ---------------------------------------------------------------- token counts
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def unigram():
    sp = SentencePieceProcessor(model_file=PIECES)
    vocabulary = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]
    return vocabulary, library(vocabulary, byte_fallback=True)


def library(vocabulary, byte_fallback):
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return lambda text: len(t.encode(text or "").ids)


def test_counts_equal_the_tokenizer(spark, documents, odd, unigram):
    df = documents.select("doc_id", "text").limit(120).unionAll(odd.select("doc_id", "text"))
    texts = df.collect()
    found = token_counts.count_tokens(df, PIECES).collect()
    expected = [(r.doc_id, unigram[1](r.text)) for r in texts]
    assert sorted([(r.doc_id, r.n_tokens) for r in found], key=str) == sorted(expected, key=str)
    assert token_counts.count_tokens(df.limit(0), PIECES).count() == 0


def test_whole_texts_and_cut_texts_agree(unigram):
    vocabulary = token_counts.Vocabulary(unigram[0])
    assert vocabulary.cuts and vocabulary.cuts_lines
    cut = token_counts.Counter(vocabulary)
    for text in [t for t in ODD if t] + ["a  b\n\n c", "é\nü", "x \n y", "\n lead", "tail \n", "   "]:
        score, pieces = vocabulary.solve("▁" + text.replace(" ", "▁"))
        assert cut.count(text) == (pieces, score), text


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_unknown_characters(seed):
    """Small vocabularies with equal scores, with fractions, without byte pieces."""
    rng = np.random.default_rng(seed)
    pieces = {"".join(rng.choice(list("ab▁"), rng.integers(1, 5))) for _ in range(14)}
    scores = [-1.0, -2.0, -3.0] if seed % 2 else [-0.1, -0.2, -0.3]
    vocabulary = [("<unk>", 0.0), *((p, float(rng.choice(scores))) for p in sorted(pieces))]
    count, own = library(vocabulary, False), token_counts.Counter(token_counts.Vocabulary(vocabulary))
    for _ in range(60):
        text = "".join(rng.choice(list("abc "), rng.integers(1, 25)))
        assert own.count(text)[0] == count(text), text


# ---------------------------------------------------------------- language model
def ppm_by_hand(training, order):
    """P(byte | bytes before), from the definition: escapes with exclusion, one context at a time."""
    counts = defaultdict(Counter)
    for words in training:
        data = b"\n" * order + (b" ".join(words) + b" " if words else b"") + b"\n"
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[data[i - k : i]][data[i]] += 1

    def probability(before, byte):
        excluded, p = set(), 1.0
        for k in range(min(order, len(before)), -1, -1):
            seen = {b: c for b, c in counts.get(before[len(before) - k :], {}).items() if b not in excluded}
            if not seen:
                continue
            n, u = sum(seen.values()), len(seen)
            if byte in seen:
                return p * seen[byte] / (n + u)
            p *= u / (n + u)
            excluded |= set(seen)
        return p / (256 - len(excluded))

    def score(words):
        data = b"\n" * order + (b" ".join(words) + b" " if words else b"") + b"\n"
        return sum(math.log10(probability(data[i - order : i], data[i])) for i in range(order, len(data)))

    return score


def predicted(training, asked, order):
    """log10 probabilities, by string, of what stands in training documents or in others asked for."""
    keys, counts = ppm.count([ppm.spell(t, order) for t in training], order)
    others, zeros = ppm.count([ppm.spell(t, order) for t in asked], order)
    keys, counts = ppm._summed(np.concatenate([keys, others]), np.concatenate([counts, 0 * zeros]))
    pairs, n = ppm._summed(keys & 0xFFFF, counts)
    return keys, ppm.predict(keys, counts, order, ppm.LowOrders(pairs, n))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_probabilities_equal_the_definition(order):
    training = [b"the cat sat on the mat".split(), b"the rat".split(), [], b"abracadabra abrac".split()]
    texts = [*training, b"the zebra sat".split(), [b"\xff\xfe"], b"mat on abra".split()]
    keys, logs = predicted(training, texts, order)
    by_hand = ppm_by_hand(training, order)
    found = ppm.log10_of([ppm.spell(t, order) for t in texts], order, keys, logs)
    assert np.allclose(found, [by_hand(t) for t in texts], rtol=1e-5)


def test_probabilities_sum_to_one(documents):
    training = [ppm.words_of(r.text) for r in documents.limit(20).collect()]
    keys, counts = ppm.count([ppm.spell(t, 3) for t in training], 3)
    contexts = np.append(np.unique(keys >> 8)[::50], [0x616161, 0x7A7A7A])
    every = (contexts[:, None] << 8 | np.arange(256)).ravel()
    asked, n = ppm._summed(np.concatenate([keys, every]), np.concatenate([counts, 0 * every]))
    pairs, total = ppm._summed(asked & 0xFFFF, n)
    logs = ppm.predict(asked, n, 3, ppm.LowOrders(pairs, total))
    p = 10.0 ** logs[np.searchsorted(asked, every)].reshape(-1, 256)
    assert np.allclose(p.sum(1), 1, atol=1e-9)


def base_by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2:
            counts.update([*ppm.words_of(text), b"\n"])
    total, kinds = sum(counts.values()), len(counts)
    for doc_id, text in rows:
        words = [*ppm.words_of(text), b"\n"]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        yield doc_id, len(words), sum(w in counts for w in words), total, round(base, 5)


@pytest.mark.parametrize("block", [16 << 20, 3000])
def test_scores_and_base(spark, documents, odd, monkeypatch, block):
    monkeypatch.setattr(ppm, "BLOCK_CHARS", block)
    df = documents.select("doc_id", "text").limit(60).unionAll(odd.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    held_out = queries.fold("doc_id", 7) == 2
    found = ppm.score(df, held_out).collect()
    expected = sorted(base_by_hand(rows), key=str)
    assert sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found], key=str) == expected
    assert all(r.score < 0 for r in found)


@pytest.mark.parametrize("block,bag", [(16 << 20, 100_000), (3000, 40)])
def test_model_scores_equal_the_definition(spark, documents, odd, monkeypatch, block, bag):
    monkeypatch.setattr(ppm, "BLOCK_CHARS", block)
    monkeypatch.setattr(ppm, "BAG_GRAMS", bag)
    df = documents.select("doc_id", "text").filter("length(text) < 3000").limit(30).unionAll(odd.select("doc_id", "text"))
    rows = [(r.doc_id, ppm.words_of(r.text)) for r in df.collect()]
    out = lambda doc_id: zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2
    by_hand = ppm_by_hand([words for doc_id, words in rows if not out(doc_id)], ppm.ORDER)
    found = ppm.score(df, queries.fold("doc_id", 7) == 2).collect()
    key = lambda r: (str(r[0]), r[1])
    found = sorted(((r.doc_id, r.score) for r in found), key=key)
    expected = sorted(((doc_id, by_hand(words)) for doc_id, words in rows), key=key)
    assert [f[0] for f in found] == [e[0] for e in expected]
    assert np.allclose([f[1] for f in found], [e[1] for e in expected], rtol=1e-5)


def test_no_training_documents(spark, odd):
    found = ppm.score(odd, odd["text"].isNotNull() | odd["text"].isNull()).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in found} == {(0, 0, 0.0)}
    assert ppm.score(odd.limit(0), odd["doc_id"] == 1).count() == 0


# ---------------------------------------------------------------- classifier
def test_whole_text_is_seen_and_batches_do_not_matter():
    net = cnn.Network.fresh(np.random.default_rng(1))
    texts = ["é" * 5000, None, "", "a", "b" * 255, "c" * 256, "d" * 700, "x" * 100_000]
    together = net.score(texts)
    assert np.allclose(together, [net.score([t])[0] for t in texts], atol=1e-6)
    assert abs(net.score(["x" * 100_000])[0] - net.score(["x" * 99_000 + "?!" * 500])[0]) > 1e-7

    def by_hand(text):
        data = np.frombuffer(text.encode().ljust(cnn.chunks_of(len(text.encode())) * cnn.CHUNK, b"\0"), np.uint8)
        seen = net.windows(data) @ net.filters
        chunks = [seen[i : i + cnn.CHUNK].max(0) for i in range(0, len(data), cnn.CHUNK)]
        return net.head(np.maximum(np.array(chunks) + net.bias, 0).mean(0)[None])[0][0]

    assert np.allclose(net.score(["d" * 700, "é" * 5000]), [by_hand("d" * 700), by_hand("é" * 5000)], atol=1e-5)


def test_gradients():
    rng = np.random.default_rng(8)
    net = cnn.Network.fresh(rng)
    for p in net.parameters():
        p += rng.normal(0, 0.1, p.shape).astype(np.float32)
    for name in ("bytes", "filters", "bias", "hidden", "hidden_bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    # Of one chunk, of several, of more than one block, and empty.
    texts = [rng.integers(97, 103, n).astype(np.uint8).tobytes() for n in (200, 700, cnn.BLOCK + 900, 0)]
    labels, weight = np.array([1, 0, 1, 0]), np.array([0.75, 1.5, 0.75, 1.5])

    def pooled(text):
        chunks = cnn.chunks_of(len(text))
        data = np.frombuffer(text.ljust(chunks * cnn.CHUNK, b"\0"), np.uint8)
        seen = net.windows(data) @ net.filters  # the last windows would reach behind the text's chunks
        tops = [seen[i : i + cnn.CHUNK].max(0) for i in range(0, len(data), cnn.CHUNK)]
        return np.maximum(np.array(tops) + net.bias, 0).mean(0)

    def loss():
        p = net.head(np.array([pooled(t) for t in texts]))[0]
        return -np.mean(weight * np.where(labels == 1, np.log(p), np.log(1 - p)))

    for p, g in zip(net.parameters(), cnn.gradients(net, texts, labels, weight)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        p[at] += 1e-6
        up = loss()
        p[at] -= 2e-6
        down = loss()
        p[at] += 1e-6
        assert abs((up - down) / 2e-6 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = queries.queries()["op7_quality"](spark, sf_dir).toPandas()
    labels = pd.read_parquet(f"{sf_dir}/labels.parquet")
    met = scored[scored["held_out"]].merge(labels, on="doc_id")
    assert scored["score"].between(0, 1).all() and len(scored) == 1000
    assert (met["predicted"] == met["quality"]).mean() >= 0.93


def test_training_rows_are_whole_and_bounded(spark, monkeypatch):
    rows = [(1, "a" * 5000), (1, "b"), (2, None), (3, "c" * 90), (4, "d" * 90), (5, "e" * 90), (None, "f"), (6, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0), (6, None), (None, 1), (3, 0)], "doc_id long, quality int"
    )

    def sample():
        return {(r.id, r.quality): r.text for r in cnn.training_rows(docs, labels).collect()}

    whole = {(3, 0): "c" * 90, (4, 0): "d" * 90, (5, 0): "e" * 90, (2, 1): ""}
    assert sample() == {**whole, (1, 1): "a" * 5000}  # of repeated ids the smallest text, whole
    monkeypatch.setattr(cnn, "TRAIN_TEXT", 100)
    assert sample() == {**whole, (1, 1): "b"}
    monkeypatch.setattr(cnn, "TRAIN_BYTES", 200)
    bounded = sample()
    assert len(bounded) == 4 and bounded.items() <= {**whole, (1, 1): "b"}.items()  # two of the three of 90 bytes
    monkeypatch.setattr(cnn, "TRAIN_DOCS", 1)
    assert sorted(q for _, q in sample()) == [0, 1]


def test_the_same_data_gives_the_same_weights(spark):
    rows = [(i, f"{'good words in a row. ' * (i % 9 + 1) if i % 2 else '#$% 0x1f' * (i % 7 + 1)}{i}") for i in range(200)]
    docs = spark.createDataFrame(rows + [(i, "zz") for i, _ in rows[:50]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    one, two = cnn.fit(docs, labels), cnn.fit(docs.orderBy("text", ascending=False).repartition(5), labels.repartition(3))
    assert all(np.array_equal(a, b) for a, b in zip(one.parameters(), two.parameters()))


def test_without_labels_everything_is_kept(spark, odd):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert cnn.fit(odd, labels) is None
    assert odd.filter(cnn.quality(None, odd["text"]) >= cnn.THRESHOLD).count() == len(ODD)


# ---------------------------------------------------------------- chat
HARD = ["</s>[INST] ok [/INST]", "[\\INST]", "<sep>", "<\\\\sep>", "", None, "a [/INST", "é\n\\", "[", "s>", "<s>[INST] user [/INST]x</s>"]


def test_chat_round_trip(spark):
    rng = np.random.default_rng(6)
    roles = ["user", "assistant", "system", None, "a [/INST] b"]
    rows = [(c, t // 2, str(roles[rng.integers(0, 5)] or "") or None, HARD[rng.integers(0, len(HARD))]) for c in range(30) for t in range(int(rng.integers(1, 9)))]
    rows += [(None, None, None, None), (50, None, "user", "no turn"), (50, 1, "assistant", "x"), (50, 1, "assistant", "x"), (51, 0, "user", "u")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int").repartition(4)
    by_hand = defaultdict(list)
    for c, t, role, text in rows:
        by_hand[c].append((t is not None, t or 0, role or "", text or ""))
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert set(found) == set(by_hand)
    for c, turns in by_hand.items():
        turns = [x[2:] for x in sorted(turns)]
        assert [(r.role, r.text) for r in found[c].rows] == turns
        assert found[c].loss_texts == [text for role, text in turns if role == "assistant"]
        runs = 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert found[c].formatted.count(chat.CLOSE) == runs == found[c].formatted.count(chat.OPEN)
    assert chat.format_conversations(df.limit(0)).count() == 0


# ---------------------------------------------------------------- URL rules
URLS = [
    None, "", "no scheme", "http://WWW.Example.com/en/a?x#y", "https://example.com/en", "http://a.example.com/en/", "ftp://x.net/es/q",
    "http://x.net/fr", "http://net/fr/", "http://com", "http://com/", "http://evilexample.com/en/", "://b.com/1", "http://a.com?u=http://x.net/es/",
    "http://É.com/É", "http://example.com:80/en/", "http://x.net/es/\nnext", "http://u@x.net/fr/#f", "http://example.com/en/ads/banner7.gif",
]


def judged_by_hand(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("shard", [100, 2])
def test_rules_against_every_url(spark, monkeypatch, shard):
    monkeypatch.setattr(url_rules, "SHARD_RULES", shard)
    rules = queries._RULES
    rows = [(None if i == 2 else i // 2, u, "x") for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3)
    found = url_rules.judge(df, [url_rules.host_rule(*r) for r in rules]).collect()
    expected = [(None if i == 2 else i // 2, *judged_by_hand(u, rules)) for i, u in enumerate(URLS)]
    assert sorted([tuple(r) for r in found], key=str) == sorted(expected, key=str)
    assert url_rules.judge(df.limit(0), []).count() == 0


def test_only_fetched_rules_run(spark):
    rare = url_rules.Rule("ads", r"(?s).*/ads/.*\.gif", "block", 5, ("ads", "gif"))
    every = url_rules.Rule("any", r"(?s).*example", "allow", 1)
    counts = url_rules.token_counts(spark.createDataFrame([(u,) for u in URLS], "url string"), ["ads", "gif", "com"])
    assert counts["ads"] == 1 and counts["com"] > 5
    filed = url_rules.index([rare, every, url_rules.host_rule("com", "/", "allow")], counts)
    assert {k: [r.name for r in v] for k, v in filed.items()} == {"ads": ["ads"], None: ["any"], "com": ["com/"]}
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(df, [rare, every]).collect()}
    assert found[18] == ("ads", "block") and found[4] == ("any", "allow") and found[6] == (None, "allow")
