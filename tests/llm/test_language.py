import zlib

import numpy as np

from quotewright.llm import language
from quotewright.llm.common import table
from tests.llm import helpers


def test_windows_hold_every_byte():
    for size in (0, 1, 191, 192, 193, 1000):
        raw = bytes(i % 251 + 1 for i in range(size))
        rows = language.windows_of(raw, 192)
        if size % 192 and size > 192:
            assert rows[:-1].tobytes() == raw[: len(rows[:-1]) * 192] and rows[-1].tobytes() == raw[-192:]
        else:
            assert rows.tobytes().rstrip(b"\0") == raw


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (6, 20)).astype(np.uint8)
    labels = np.array([0, 1, 0, 1, 1, 0])
    net = language.train(windows, labels, ["a", "b"])

    def loss():
        pooled = 0.0
        values = net.maxima(windows)[0]
        out = language.softmax(np.maximum(values, 0) @ net.dense + net.dense_bias)
        pooled -= np.log(out[np.arange(6), labels]).mean()
        return pooled

    gradients = language._gradients(net, windows, labels, np.ones(2))
    for weights, gradient in ((net.dense, gradients[-2]), (net.bias, gradients[-3]), (net.filters[1], gradients[2])):
        place = tuple(np.argwhere(np.abs(gradient) == np.abs(gradient).max())[0])
        weights[place] += 1e-2
        above = loss()
        weights[place] -= 2e-2
        below = loss()
        weights[place] += 1e-2
        assert abs((above - below) / 2e-2 - gradient[place]) < 0.05 * abs(gradient[place]) + 2e-3


def test_edge_rows(spark):
    docs = helpers.documents(spark)
    net = language.fit_language(docs)
    rows = language.predict_language(docs, net).collect()
    given = docs.collect()
    assert len(rows) == len(given)
    texts = {}
    for row in given:
        texts.setdefault(row["doc_id"], set()).add(row["text"])
    for row in rows:
        out = row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
        assert row["held_out"] == out and 0 <= row["score"] <= 1
        no_letter = all(not any(c.isalpha() for c in text or "") for text in texts[row["doc_id"]])
        assert (row["lang_pred"] == "und") == no_letter
        assert row["lang_pred"] in ("en", "fr", "und")


def test_nothing_labelled_and_no_rows(spark):
    nothing = helpers.empty(spark)
    assert language.fit_language(nothing) is None
    assert language.predict_language(nothing, None).count() == 0
    unlabelled = helpers.documents(spark).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    net = language.fit_language(unlabelled)
    assert net is None
    assert {row["lang_pred"] for row in language.predict_language(unlabelled, net).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    net = language.fit_language(docs)
    rows = language.predict_language(docs, net).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([row["lang_pred"] == row["lang"] for row in rows]) >= 0.97


def test_labels_are_no_input(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    net = language.fit_language(docs)
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'zz' AS source")
    assert helpers.plain(language.predict_language(docs, net), "doc_id", "lang_pred") == helpers.plain(
        language.predict_language(other, net), "doc_id", "lang_pred"
    )


def plain_prediction(net, raw):
    """Windows, filters and places one by one."""
    logs = np.zeros(len(net.languages))
    rows = language.windows_of(raw)
    for row in rows:
        pooled = []
        for own in net.filters:
            for number in range(own.shape[2]):
                responses = [
                    sum(float(net.vectors[row[at + i]] @ own[i, :, number]) for i in range(len(own)))
                    for at in range(len(row) - len(own) + 1)
                ]
                pooled.append(max(responses))
        active = [max(0.0, value + bias) for value, bias in zip(pooled, net.bias)]
        scores = np.array([sum(a * w for a, w in zip(active, net.dense[:, k])) for k in range(len(logs))])
        scores = np.exp(scores + net.dense_bias)
        logs += np.log(scores / scores.sum())
    shares = np.exp(logs / len(rows))
    return shares / shares.sum()


def test_prediction_by_plain_loops():
    rng = np.random.default_rng(4)
    windows = rng.integers(97, 123, (30, language.WINDOW)).astype(np.uint8)
    net = language.train(windows, np.arange(30) % 3, ["a", "b", "c"])
    texts = [bytes(rng.integers(97, 123, size).astype(np.uint8)) for size in (1, 5, 192, 200, 450)]
    langs, scores = net.predict(texts)
    for raw, lang, score in zip(texts, langs, scores):
        shares = plain_prediction(net, raw)
        assert lang == net.languages[int(shares.argmax())]
        assert abs(shares.max() - score) < 1e-4


def test_every_label_is_learned(spark, monkeypatch):
    """More labels than the network has full samples for share the documents; none goes."""
    monkeypatch.setattr(language, "LANGUAGES", 4)
    rows = [(i, f"w{i % 12} " * 30, f"l{i % 12:02}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for most in (language.BROADCAST_LABELS, 1):
        monkeypatch.setattr(language, "BROADCAST_LABELS", most)
        net = language.fit_language(docs, documents_per_language=30)
        assert net.languages == [f"l{k:02}" for k in range(12)]
