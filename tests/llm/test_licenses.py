import re
from collections import Counter

from quotewright.llm import licenses
from quotewright.llm.common import table
from tests.llm import helpers

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def by_rule(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", helpers.lower_ascii(text or ""))
    places = []
    for phrase, label in PHRASES.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    starts = [place for place, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places})))


def test_base_by_rule(spark, sample):
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    for docs in (helpers.documents(spark), table(spark, sample, "documents")):
        rows = licenses.scan_licenses(docs).collect()
        assert Counter(tuple(row[name] for name in names) for row in rows) == Counter((row["doc_id"], *by_rule(row["text"])) for row in docs.collect())
        for row in rows:
            assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
            assert 0 <= row["score"] <= 1 and (row["score"] == 1 or not row["n_base"])


def test_long_texts_of_little_else_than_phrases():
    """Places and spans in time that grows with the text."""
    words = "all rights reserved x cc by".split() * 60_000
    places = licenses.base_places([word.encode() for word in words])
    assert sorted(places)[:3] == [(0, "reserved"), (4, "cc-by"), (6, "reserved")] and len(places) == 120_000
    template = [b"t1", b"t2", b"t3", b"t4"]
    found = licenses.aligned(template, (template + [b"x"] * 6) * 4_000, 1)
    assert [span[1:] for span in sorted(found, key=lambda span: span[1])] == [(10 * i, 10 * i + 4) for i in range(4_000)]


def scan(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {row["doc_id"]: row for row in licenses.scan_licenses(frame).collect()}


def test_templates_and_their_variants(spark):
    noise = " ".join(f"n{i}" for i in range(200))
    long = licenses.TEMPLATES[5][1]
    words = long.split()
    moved = " ".join([*words[:8], "really", *words[8:20], *words[21:]])
    rows = scan(
        spark,
        f"{noise} released under\nthe MIT License. {noise}",
        f"{noise} {long} {noise}",
        f"{noise} {moved} {noise}",
        " ".join(f"{word} {noise}" for word in words),
        f"{noise} licensed under the {noise}",
        "cc by cc by cc by",
    )
    assert [rows[i]["labels"] for i in range(6)] == ["mit", "gpl", "gpl", "", "", "cc-by"]
    assert rows[0]["score"] == 1 and 0.8 <= rows[2]["score"] < 1 or rows[2]["n_base"]


def test_one_edit_in_every_template(spark):
    """One word put in, left out or changed, but for those that name the license, and other versions."""
    texts, wanted = [], []
    for label, wording in licenses.TEMPLATES:
        words = wording.split()
        inner = [i for i, word in enumerate(words) if i and not any(
            own in licenses.NAMES or licenses.VERSION.fullmatch(own) for own in licenses.words_of(word)) and len(licenses.words_of(word)) == 1]
        if len(licenses.template_of(label, wording).words) < licenses.WORDS_AN_EDIT:
            continue
        i = inner[len(inner) // 2]
        texts += [[*words[:i], "really", *words[i:]], [*words[:i], *words[i + 1 :]], [*words[:i], "other", *words[i + 1 :]]]
        wanted += [label] * 3
    for text, label in (
        ("Licensed under the Apache License 2.0", "apache-2.0"), ("Licensed under the MIT License", "mit"),
        ("Licensed under CC BY-NC 3.0", "cc-by-nc"), ("CC BY-SA 4.0", "cc-by-sa"), ("CC BY-NC-SA 2.0", "cc-by-nc-sa"),
    ):
        texts.append(text.split())
        wanted.append(label)
    rows = scan(spark, *(f"n1 n2 n3 {' '.join(words)} n4 n5 n6" for words in texts))
    missed = [" ".join(texts[i]) for i, label in enumerate(wanted) if label not in rows[i]["labels"].split(",")]
    assert not missed
    others = scan(spark, "Released under the other License", "Licensed under the Apache License, Version 1.1", "licensed under the terms of the", "Licensed under CC BY-NC-SA 4.0")
    assert [others[i]["labels"] for i in range(4)] == ["", "", "", "cc-by,cc-by-nc-sa"]


def test_spans_by_comparing_words(spark):
    noise = [f"n{i}" for i in range(50)]
    label, wording = licenses.TEMPLATES[0]
    words = [w.decode() for w in licenses.words_of(wording)]
    text = " ".join(noise + words + noise + words + noise)
    frame = spark.createDataFrame([("k", text), ("k", text)], "key string, text string")
    spans = [(r["first_word"], r["end_word"], r["coverage"]) for r in licenses.template_spans(frame).filter(f"label = '{label}'").collect()]
    assert sorted(spans) == [(50, 50 + len(words), 1.0), (100 + len(words), 100 + 2 * len(words), 1.0)]


def test_no_rows(spark):
    assert licenses.scan_licenses(helpers.empty(spark)).count() == 0
