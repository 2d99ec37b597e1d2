import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from corpusloom.llm import langid, masked_lm as lm
from corpusloom.llm.text import buffers
from llm_data import DOCUMENT, text_of, words


def plain_grams(text):
    """N-grams of one to three of the words, as (lengths, characters)."""
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    found = Counter()
    padded = f" {low} "
    for k, c in enumerate(padded):
        if c != " ":
            found[c] += 1
        two, three = padded[k : k + 2], padded[k : k + 3]
        if len(two) == 2 and two != "  ":
            found[two] += 1
        if len(three) == 3 and three[1] != " ":
            found[three] += 1
    return found


def test_grams_are_counted_in_their_rows():
    texts = ["Été à 3 b", None, "", "b", "!!", "ab", "日本 x", "a" * 3000]
    data, off = buffers(pa.array(texts))
    got = [Counter() for _ in texts]
    for bucket, row in langid.grams(data, off, 24):
        for b, r in zip(bucket.tolist(), row.tolist()):
            got[r][b] += 1
    want = [plain_grams(t) for t in texts]
    assert [sum(g.values()) for g in got] == [sum(w.values()) for w in want]
    assert [sorted(g.values()) for g in got] == [sorted(w.values()) for w in want]


def test_held_out_accuracy(documents):
    rows = langid.identify(documents).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in tested) >= 0.98 * len(tested)
    assert all(0.0 <= r.score <= 1.0 for r in rows)


def test_prediction_equals_plain_bayes(spark):
    rows = [(k, text_of(k, 30) if k % 2 else " ".join("ñu é" for _ in words(k, 20)), "aa" if k % 2 else "bb", None, None)
            for k in range(40)]
    frame = spark.createDataFrame(rows, DOCUMENT)
    model = langid.learn(frame, bits=20)
    assert model.languages == ["aa", "bb"]
    seen = {"aa": Counter(), "bb": Counter()}
    for _, text, lang, _, _ in rows:
        seen[lang].update(plain_grams(text))
    got = langid.predict(frame, model).collect()
    size, text = 1 << 20, rows[0][1]
    z = []
    for lang in ("aa", "bb"):
        total = sum(seen[lang].values()) + langid.SMOOTHING * size
        z.append(math.log(0.5) + sum(n * math.log((seen[lang][g] + langid.SMOOTHING) / total) for g, n in plain_grams(text).items()))
    assert got[0].lang_pred == ("aa", "bb")[int(np.argmax(z))]
    assert abs(got[0].score - 1 / sum(math.exp(v - max(z)) for v in z)) < 1e-6


def test_langid_edges(spark, edge, nothing):
    rows = langid.identify(edge).collect()
    assert len(rows) == edge.count()
    by_id = {r.doc_id: r for r in rows}
    for key in (1, 2, 3):
        assert (by_id[key].lang_pred, by_id[key].score) == (langid.UNDETERMINED, 0.0)
    assert by_id[4].lang_pred in ("en", "fr") and not by_id[None].held_out
    assert langid.identify(nothing).count() == 0
    unlabelled = edge.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {langid.UNDETERMINED}


def test_word_counts_cover_all_texts(documents):
    total = sum(r.n for r in lm.count_words(documents).collect())
    import re

    word = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [r.text.translate(lower) for r in documents.collect()]
    assert total == sum(len(word.findall(t)) for t in texts)
    assert lm.count_words(documents).count() == len({w for t in texts for w in word.findall(t)})


def test_probabilities_sum_to_one(documents):
    known, net = lm.train(documents, rounds=1)
    assert abs(np.exp(known.inside).sum() - len(set(known.kind[: known.size].tolist()))) < 1e-6
    rng = np.random.default_rng(1)
    around = rng.integers(0, known.size + 1, (5, 2 * lm.REACH))
    _, _, z, e, total = lm.forward(net, around)
    for k in range(5):
        share = e[k] / total[k]
        whole = sum(share[known.kind[w]] * math.exp(known.inside[w]) for w in range(known.size))
        used = sorted(set(known.kind[: known.size].tolist()))
        assert abs(whole - share[used].sum()) < 1e-4


def test_gradient_of_a_step():
    rng = np.random.default_rng(2)
    net = {k: v.astype(np.float64) for k, v in lm.first_network(30).items()}
    around, target = rng.integers(0, 31, (8, 2 * lm.REACH)), rng.integers(0, lm.CLASSES, 8)

    def loss(n):
        _, _, z, _, total = lm.forward(n, around)
        return float(np.mean(np.log(total) - z[np.arange(8), target]))

    square = {k: np.full(v.shape, 1e12) for k, v in net.items()}
    moved = {k: v.copy() for k, v in net.items()}
    lm.train_step(moved, square, around, target)
    for name, at in (("w", (3, 4)), ("u", (2, int(target[0]))), ("b", (5,)), ("e", (int(around[0, 0]), 1))):
        step = {k: v.copy() for k, v in net.items()}
        step[name][at] += 1e-5
        slope = (loss(step) - loss(net)) / 1e-5
        assert abs((net[name][at] - moved[name][at]) * 1e6 / lm.RATE - slope) < 1e-4


def test_a_step_touches_its_own_words_alone():
    rng = np.random.default_rng(3)
    size, words_used = 500_000, np.array([7, 8, 499_999, 500_000])
    net = {"e": rng.normal(0, 0.1, (size + 1, lm.WIDTH)).astype(np.float32)}
    net |= {k: v for k, v in lm.first_network(4).items() if k != "e"}
    square = {k: np.full(v.shape, 1e-4, np.float32) for k, v in net.items()}
    around, target = rng.choice(words_used, (64, 2 * lm.REACH)), rng.integers(0, lm.CLASSES, 64)

    # What a step does to the vectors, over the whole table.
    x, hidden, z, e, total = lm.forward(net, around)
    dz = e / total[:, None]
    dz[np.arange(64), target] -= 1.0
    dz /= 64
    dx = ((dz @ net["u"].T) * (1.0 - hidden * hidden)) @ net["w"].T
    g = np.zeros((size + 1, lm.WIDTH))
    np.add.at(g, around.reshape(-1), dx.reshape(-1, lm.WIDTH).astype(np.float64))
    g = g.astype(np.float32)
    wanted = net["e"] - lm.RATE * g / np.sqrt(np.float32(1e-4) + g * g)

    tracemalloc.start()
    lm.train_step(net, square, around, target)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(net["e"], wanted)
    assert np.flatnonzero((square["e"] != np.float32(1e-4)).any(axis=1)).tolist() == words_used.tolist()
    assert held < net["e"].nbytes // 2


def test_ids_by_prefix_equal_a_search():
    rng = np.random.default_rng(4)
    top = (1 << 64) - 1
    crowded = [0, 1, 5, 1 << 63, (1 << 63) + 3, top - 1]
    held = np.unique(np.array(crowded + rng.integers(0, 1 << 63, 200).tolist(), np.uint64))
    asked = np.concatenate([held, np.array([2, 6, (1 << 63) + 1, top], np.uint64), rng.integers(0, 1 << 63, 500).astype(np.uint64)])
    for some in (held, np.append(held, np.uint64(top)), held[:0]):
        ones = np.ones(len(some), np.int64)
        known = lm.Words(some, ones, ones, np.zeros(lm.BUCKETS, np.int64))
        at = {int(h): k for k, h in enumerate(some)}
        assert known.ids(asked).tolist() == [at.get(h, len(some) + h % lm.BUCKETS) for h in asked.tolist()]


def test_neighbours_stay_in_their_document():
    around = lm.contexts(np.array([1, 2, 3, 4]), np.array([0, 3, 3, 4]), 9)
    assert around.tolist() == [[9, 9, 2, 3], [9, 1, 3, 9], [1, 2, 9, 9], [9, 9, 9, 9]]


def test_context_helps_and_scores_are_whole(spark, documents):
    known, net = lm.train(documents)
    rows = {r.doc_id: r for r in lm.score(documents, known, net).collect()}
    assert len(rows) == documents.count()
    start = lm.first_network(known.size)
    start["u"][:] = 0
    before = {r.doc_id: r for r in lm.score(documents, known, start).collect()}
    long = [k for k in rows if rows[k].n_tokens > 20]
    gain = np.mean([rows[k].mean_log_likelihood - before[k].mean_log_likelihood for k in long])
    assert gain > 0.01
    # 200 documents are a few steps; more rounds over them gain more.
    more = net
    for _ in range(6):
        more = lm.train_round(documents, known, more)
    after = {r.doc_id: r.mean_log_likelihood for r in lm.score(documents, known, more).collect()}
    assert np.mean([after[k] - before[k].mean_log_likelihood for k in long]) > 2 * gain
    # The score is the sum over the words, each from both of its sides.
    text = documents.first().text
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = lm.score(one, known, net).first()
    assert abs(got.log_likelihood - rows[documents.first().doc_id].log_likelihood) < 1e-3


def test_every_word_is_masked_once():
    bounds, phase = np.array([0, 1, 1, 9, 30]), np.array([0, 1, 1, 2])
    for turns in (1, 2, 3):
        chosen = [lm.masked(bounds, phase, k, turns) for k in range(turns)]
        assert sorted(np.concatenate(chosen).tolist()) == list(range(30))


def test_every_column_of_a_template_is_learnt(spark):
    """A text with a period of seven words: each is predicted from its neighbours."""
    template = "alpha bravo charlie delta echo foxtrot golf "
    frame = spark.createDataFrame([(k, template * 60) for k in range(60)], "doc_id long, text string")
    known, net = lm.train(frame)
    for k in range(3):
        net = lm.train_round(frame, known, net)
    data, off = buffers(pa.array([template * 3]))
    ids, bounds = lm._block_ids(data, off, 0, 1, known)[:2]
    around, target = lm.contexts(ids, bounds, known.size)[7:14], known.kind[ids][7:14]
    _, _, _, e, total = lm.forward(net, around)
    assert len(set(target.tolist())) == 7
    assert (e.argmax(axis=1) == target).all()


def test_rare_words_have_their_own_share(spark):
    rows = [(k, " ".join([f"w{j}" for j in range(20)] + ["often"] * 3 * (k < 5) + [f"once{k}"])) for k in range(30)]
    frame = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string")
    known = lm.build_words(frame, size=20)
    net = lm.first_network(known.size)
    net["u"][:] = 0  # every class is as likely
    counts = Counter(w for _, text in [*rows, rows[0]] for w in text.split())
    rare = sum(n for w, n in counts.items() if not w.startswith("w")) + lm.BUCKETS
    share = {}
    for r in lm.score(spark.createDataFrame([(k, f"w{k}") for k in range(20)], "doc_id long, text string"), known, net).collect():
        share[f"w{r.doc_id}"] = r.log_likelihood
    got = sorted((r.doc_id or 0, r.log_likelihood) for r in lm.score(frame, known, net).collect())
    want = sorted(
        (k, sum(share[w] if w in share else math.log(counts[w] / rare / lm.CLASSES) for w in text.split()))
        for k, text in [*rows, rows[0]]
    )
    assert [k for k, _ in got] == [k for k, _ in want] and np.allclose([v for _, v in got], [v for _, v in want])
    # A word that the corpus has once or never is less likely than one that it has often.
    new = spark.createDataFrame([(1, "often"), (2, "once1 "), (3, "never"), (4, "w3")], "doc_id long, text string")
    often, once, never, known_word = (r.log_likelihood for r in lm.score(new, known, net).orderBy("doc_id").collect())
    assert known_word > often > once and abs(once - math.log(2 / rare / lm.CLASSES)) > 0.1 and never <= once


def test_lm_edges(spark, edge, nothing):
    rows = lm.pseudo_likelihood(edge).collect()
    assert len(rows) == edge.count()
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_tokens, by_id[1].log_likelihood, by_id[1].mean_log_likelihood) == (0, 0.0, None)
    assert by_id[4].n_tokens == 6000 and by_id[4].log_likelihood < 0
    assert lm.pseudo_likelihood(nothing).count() == 0
