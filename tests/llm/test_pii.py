import hashlib
import re
from collections import Counter

import numpy as np

from quotewright.llm import pii
from quotewright.llm.common import table
from tests.llm import helpers


def by_rule(text):
    """The base patterns as they are written, with nothing done for speed."""

    def digits(body):
        return re.sub("[^0-9]", "", body)

    def luhn(number):
        total = 0
        for place, digit in enumerate(reversed(number)):
            value = int(digit) * (2 if place % 2 else 1)
            total += value - 9 if value > 9 else value
        return total % 10 == 0

    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ip = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    card = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    phone = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return {"email": email, "ip": ip, "card": card, "phone": phone}


def test_base_spans_by_rule():
    rng = np.random.default_rng(0)
    texts = ["", "a@b.c@d.e", "a@b@c.d", "@b.c", "a@b..c", "x1.2.3.4.5.6.7.8", "1.2.3.999", "001.02.3.255", "4111 1111 1111 1111",
             "4111-1111-1111-1111-4", "+1 (555) 123-4567.", "+1+2 3456789", "+1234567", "+123456789012345 6", "é4111111111111111ß"]
    alphabet = list("ab0123456789.@-+ ()%é\n")
    texts += ["".join(rng.choice(alphabet, rng.integers(1, 60))) for _ in range(3000)]
    for text in texts:
        assert pii.base_spans(text) == by_rule(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "+1" + "(" * 200_000, "at " * 50_000, "1 at 1.1" * 20_000):
        pii.base_spans(text)
        pii.candidates(text)


def test_a_spoken_name_is_proposed_whole():
    for name in ("a" * 80, "x." * 5000 + "y", "b"):
        text = f"mail {name} at mail.example.org now"
        assert [text[s:e] for own, s, e in pii.candidates(text) if own == "email"] == [f"{name} at mail.example.org"]


def test_data_beside_other_numbers_is_proposed():
    for text, kind, wanted in (
        ("4111 1111 1111 1111 05/27", "card", ["4111 1111 1111 1111"]),
        ("no 17 4111-1111-1111-1111 99", "card", ["4111-1111-1111-1111"]),
        ("(555) 123-4567 (555) 987-6543", "phone", ["(555) 123-4567", "(555) 987-6543"]),
        ("(4111.1111.1111.1111)", "card", ["4111.1111.1111.1111"]),
        ("999.10.0.0.1", "ip", ["10.0.0.1"]),
        ("1 " * 40 + "555-123-4567" + " 2" * 40, "phone", ["555-123-4567"]),
    ):
        proposed = {text[s:e] for own, s, e in pii.candidates(text) if own == kind}
        assert proposed >= set(wanted), text


def test_queries_rows(spark):
    docs = helpers.documents(spark)
    rows = pii.find_pii(docs, pii.fit_pii(docs)).collect()
    given = sorted((row["doc_id"] is not None, row["doc_id"] or 0, row["text"] or "") for row in docs.collect())
    assert len(rows) == len(given)
    digests = {}
    for row in rows:
        digests.setdefault(row["doc_id"], set()).add((row["n_email"], row["n_ip"], row["n_card"], row["n_phone"], row["base_sha256"]))
    for known, doc_id, text in given:
        base = by_rule(text)
        found = (*(len(base[kind]) for kind in pii.KINDS), hashlib.sha256(pii.joined(base).encode()).hexdigest())
        assert found in digests[doc_id if known else None]
    row = next(row for row in rows if row["n_email"] and row["doc_id"] == 19)
    assert (row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1)


def test_no_rows(spark):
    nothing = helpers.empty(spark)
    model = pii.fit_pii(nothing)
    assert model.booster is None and pii.find_pii(nothing, model).count() == 0


def test_boosted_trees_learn_and_generalise():
    rng = np.random.default_rng(1)
    rows = rng.normal(0, 1, (4000, 6))
    labels = ((rows[:, 1] > 0.3) & (rows[:, 4] < 0.5)).astype(int)
    booster = pii.boost(rows[:3000], labels[:3000])
    assert ((booster.score(rows[3000:]) > 0.5) == labels[3000:]).mean() > 0.96


def test_model_adds_forms_the_patterns_miss(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    model = pii.fit_pii(docs)
    for text, kind in (("please call me (555) 123-4567 today", "phone"), ("the card 4111.1111.1111.1111 is", "card")):
        base, every = model.spans(text)
        assert not base[kind] and len(every[kind]) == 1
    clean = "In 1999-2004 we sold 1234567 of version 1.2.3.400 on 2024-01-15 at noon. Then 12.5 percent"
    assert pii.joined(model.spans(clean)[1]) == ""
    rows = pii.find_pii(docs, model).collect()
    added = sum(row["spans"].count(":") // 2 - row["n_email"] - row["n_ip"] - row["n_card"] - row["n_phone"] for row in rows)
    assert 0 <= added <= 0.002 * len(rows)


def test_altered_forms_that_are_common_in_the_corpus_are_found(spark):
    """Altered forms stand in most documents that the fit looks at."""
    rng = np.random.default_rng(6)

    def number(count):
        return "".join(map(str, rng.integers(0, 10, count)))

    def card():
        head = number(15)
        return next(head + d for d in "0123456789" if pii.luhn(head + d))

    def altered(i):
        if i % 4 == 0:
            return "phone", f"({number(3)}) 555-{number(4)}", ""
        if i % 4 == 1:
            return "email", f"name{i} [at] host{i % 7} [dot] org", ""
        digits = card()
        if i % 4 == 2:
            return "card", ".".join(digits[j : j + 4] for j in range(0, 16, 4)), ""
        return "card", " ".join(digits[j : j + 4] for j in range(0, 16, 4)), " 05/27"

    def prose():
        return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(12))

    rows, planted = [], {}
    for i in range(1200):
        if i % 3:
            kind, body, after = altered(i // 3)
            head = prose() + " "
            rows.append((i, f"{head}{body}{after} {prose()}"))
            planted[i] = f"{kind}:{len(head)}:{len(head) + len(body)}"
        else:
            true = (f"us{i}.er@mail{i % 9}.example.com", f"+1 ({number(3)}) 555-{number(4)}", card(), f"10.{i % 200}.7.{i % 250}")[i // 3 % 4]
            rows.append((i, f"{prose()} {true} {prose()} {2000 + i % 20}-03-{10 + i % 19} {number(9)} {number(3)}.{number(5)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {row["doc_id"]: row for row in pii.find_pii(docs, pii.fit_pii(docs)).collect()}
    missed = Counter(planted[i].split(":")[0] for i in planted if planted[i] not in out[i]["spans"].split(","))
    counts = Counter(span.split(":")[0] for span in planted.values())
    assert all(missed[kind] <= 0.1 * counts[kind] for kind in counts), missed
    wrong = sum(out[i]["spans"].count(":") // 2 != 1 for i in out)
    assert wrong <= 0.05 * len(out), wrong


def test_redaction_merges_overlaps():
    spans = {"email": [(0, 5)], "ip": [], "card": [(8, 20)], "phone": [(15, 25), (26, 28)]}
    text = "a@b.c - " + "1" * 18 + "xx"
    assert pii.redact(text, spans) == "[EMAIL] - [CARD]1[PHONE]"


def test_other_columns_stay(spark):
    docs = helpers.documents(spark)
    out = pii.redact_pii(docs, pii.PiiModel(None, {}), length_col="n_chars")
    assert out.columns == docs.columns and out.count() == docs.count()
    row = out.filter("doc_id = 19").first()
    assert row["text"] == "mail [EMAIL], [PHONE], [IP], [CARD]" and row["n_chars"] == len(row["text"])
    assert out.filter("doc_id = 0").first()["text"] is None
