"""Personal data: base patterns, and spans proposed by generators and chosen by boosted trees."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import map_batches

Span = tuple[int, int]

# The kinds in their order, and the characters of their base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Runs are taken whole and begun at their first digit, which finds the same matches in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
GROUP = re.compile(r"[0-9]++")
# The most digits that any kind has.
MOST_DIGITS = 19

# Bounds of the fit: documents looked at, candidates taken.
FIT_DOCUMENTS, FIT_CANDIDATES = 20_000, 30_000
TREES, DEPTH, RATE, CUTS, LEAST = 60, 3, 0.2, 16, 8
# Share of the candidates taken that have to be right among those kept apart, and the least score of any.
PRECISION, LEAST_SCORE = 0.99, 0.5
# Wrong runs of numbers that one planted form, and one list of numbers, gives the fit.
WRONG_RUNS = 6
AROUND = 32
# Candidates scored at a time, which bounds the memory for a text full of numbers.
SCORED = 4096
SEED = 3


def digits_of(body: str) -> str:
    return "".join(DIGIT.findall(body))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str) -> list[Span]:
    """Every ``@`` with the run of address characters before it, not going into the last match."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost non-overlapping matches of each kind; those that fail its test are dropped."""
    spans: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        spans["email"] = _emails(text)
    if DIGIT.search(text):
        spans["ip"] = [m.span() for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in CARD.finditer(text):
            digits = digits_of(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans["card"].append(m.span())
        if "+" in text:
            spans["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return spans


# --- candidates ---------------------------------------------------------------

AT = re.compile(r" ?[(\[]at[)\]] ?| at ")
SPOKEN_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}+(?:(?: ?[(\[]dot[)\]] ?| dot |\.)[A-Za-z0-9-]{2,63}+)++")
NUMBER = re.compile(r"(?<![0-9])\+?\(?[0-9]++(?:[ ().-]{1,2}[0-9]++)*+")
HINTS = {
    "email": frozenset("mail email e-mail contact write address".split()),
    "ip": frozenset("ip host address server from".split()),
    "card": frozenset("card visa mastercard credit debit pan".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax".split()),
}
# Dates, spans of years and decimal numbers, which have the digits of a phone; ends of a plausible domain.
NO_PHONE = re.compile(
    r"(?:1[0-9]|20)[0-9]{2}[-. ](?:0?[1-9]|1[0-2])[-. ][0-3]?[0-9](?![0-9]).*|[0-3]?[0-9][-. ][0-3]?[0-9][-. ](?:1[0-9]|20)[0-9]{2}(?![0-9]).*"
    r"|(?:1[0-9]|20)[0-9]{2} ?- ?(?:1[0-9]|20)[0-9]{2}|[0-9]+\.[0-9]+"
)
ENDING = re.compile(r"(?:\.|dot[)\]]? ?)(?:[a-z]{2}|com|org|net|edu|gov|info|biz|example)$")


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping (kind, start, end) proposals, far more than are personal data."""
    found = []
    if "at" in text:
        for mark in AT.finditer(text):
            domain = SPOKEN_DOMAIN.match(text, mark.end())
            start = mark.start()
            while start and text[start - 1] in LOCAL:
                start -= 1
            if domain and start < mark.start():
                found.append(("email", start, domain.end()))
    if DIGIT.search(text):
        for match in NUMBER.finditer(text):
            for start, end, count, groups in _number_runs(text, match):
                if 7 <= count <= 15:
                    found.append(("phone", start, end))
                if 13 <= count <= MOST_DIGITS:
                    found.append(("card", start, end))
                if groups == 4 and count <= 12 and text.count(".", start, end) == 3:
                    found.append(("ip", start, end))
    return found


def _number_runs(text: str, match: re.Match) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, digits, groups) of every run of neighbouring groups of at most ``MOST_DIGITS``.

    A run takes the plus before it, and an opening bracket that it closes.
    """
    groups = [group.span() for group in GROUP.finditer(text, *match.span())]
    for first, (start, _) in enumerate(groups):
        count = 0
        for last in range(first, len(groups)):
            opened, end = groups[last]
            count += end - opened
            if count > MOST_DIGITS:
                break
            begin = start
            if begin > match.start() and text[begin - 1] == "(" and text.find(")", begin, end) >= 0:
                begin -= 1
            if begin > match.start() and text[begin - 1] == "+":
                begin -= 1
            yield begin, end, count, last - first + 1


def _class(char: str) -> int:
    return 0 if not char else 1 if char.isspace() else 2 if char.isalpha() else 3 if char.isdigit() else 4


def _hinted(kind: str, left: str) -> bool:
    return any(word.strip(":.,;()") in HINTS[kind] for word in left.lower().split()[-3:])


def features(kind: str, left: str, body: str, right: str) -> list[float]:
    """Format of a candidate and of what stands around it."""
    digits = digits_of(body)
    groups = [len(group) for group in re.findall(r"[0-9]+", body)] or [0]
    parts = body.split(".")
    return [
        KINDS.index(kind),
        len(body),
        len(digits),
        len(groups),
        max(groups),
        min(groups),
        body.count(" "),
        body.count("."),
        body.count("-"),
        body.count("(") + body.count(")"),
        body.startswith("+"),
        luhn(digits) if digits else 0,
        len(parts) == 4 and all(p.isdigit() and _small(p) for p in parts),
        sum(map(str.isalpha, body)),
        3 if " at " in body else 2 if re.search(r"[(\[]at[)\]]", body) else 1 if "@" in body else 0,
        2 if " dot " in body else 1 if re.search(r"[(\[]dot[)\]]", body) else 0,
        _class(left[-1:]),
        _class(right[:1]),
        _hinted(kind, left),
        any(mark in left[-3:] for mark in "=\"'/"),
        len(DIGIT.findall(left[-20:])),
        len(parts[-1]),
        len(DIGIT.findall(right[:20])),
        groups[0],
        groups[-1],
        len(set(re.findall(r"[ ().-]+", body))),
        ENDING.search(body) is not None,
    ]


def doubtful(kind: str, left: str, body: str, right: str) -> bool:
    """Whether an unverified candidate may well be personal data, so that it is an example of neither label."""
    if _hinted(kind, left):
        return True
    if kind == "card":
        return luhn(digits_of(body))
    if kind == "ip":
        return all(map(_small, GROUP.findall(body)))
    if kind == "email":
        return bool(ENDING.search(body) or re.search(r"[(\[](?:at|dot)[)\]]", body))
    inside = (left[-1:] + right[:1]).replace("_", "a")
    return not any(map(str.isalnum, inside)) and (
        body.startswith("+") or len(GROUP.findall(body)) > 1 and not NO_PHONE.fullmatch(body)
    )


def _forms(kind: str, body: str, random: np.random.Generator) -> tuple[list[str], list[str]]:
    """Other forms of a true span, and look-alikes that are none."""
    number = str(random.integers(10**9, 10**10))
    if kind == "email":
        name, _, domain = body.partition("@")
        dotted = domain.replace(".", " [dot] ")
        other = [f"{name} at {domain}", f"{name}(at){domain}", f"{name} [at] {domain}", f"{name} [at] {dotted}", f"{name} at {domain.replace('.', ' dot ')}"]
        head = re.sub(r"[^A-Za-z]", "", name) or "it"
        return other, [f"{head} at {number[:3]}.{number[3:6]}", f"{head} at the.Of", f"{head} at noon.Then"]
    if kind == "phone":
        bare = body.lstrip("+")
        national = re.sub(r"^[0-9]{1,3}[ .-]", "", bare)
        other = [bare]
        if national != bare:
            groups = GROUP.findall(national)
            other += [national, *(mark.join(groups) for mark in "-. " if len(groups) > 1)]
        return other, [digits_of(body), number, f"{number[:7]}.{number[7:]}", f"{1900 + int(number[:2])}-{1900 + int(number[2:4])}", f"{2000 + int(number[:2])}-0{number[5]}-1{number[6]} 1{number[7]}"]
    if kind == "card":
        digits = digits_of(body)
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + random.integers(8)) % 10)
        grouped = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [digits, *(mark.join(grouped) for mark in ". -")], [wrong, " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), digits[:14] + "0"]
    return [body], [f"{number[:3]}.{number[3]}.{number[4]}.999", f"{number[0]}.{number[1]}.{number[2:4]}"]


def _another(kind: str, body: str, random: np.random.Generator) -> str:
    """A true span of the same form with other digits."""
    out = DIGIT.sub(lambda _: str(random.integers(10)), body)
    if kind == "card":
        last = max(m.start() for m in DIGIT.finditer(out))
        return next(own for d in "0123456789" if luhn(digits_of(own := out[:last] + d + out[last + 1 :])))
    return out


def _planted(kind: str, body: str, random: np.random.Generator) -> tuple[str, list[Span]]:
    """A true span alone or beside numbers or another one of its form, and where the true ones are."""
    # Fewer than four digits before a phone would be its country.
    numbers = [str(random.integers(1000, 10**6)), str(random.integers(10, 10 ** random.integers(2, 7)))]
    choice = 0 if kind == "email" else random.integers(6)
    if choice == 3:
        other = _another(kind, body, random)
        return f"{body} {other}", [(0, len(body)), (len(body) + 1, len(body) + 1 + len(other))]
    before = numbers[0] + " " if choice in (4, 5) else ""
    after = " " + numbers[1] if choice in (2, 5) else ""
    return before + body + after, [(len(before), len(before) + len(body))]


def _layout(body: str) -> list[int]:
    return [len(group) for group in GROUP.findall(body)]


def training_rows(doc_id: int, text: str) -> list[tuple[int, list[float]]]:
    """(label, features): base spans and their other forms against what is surely none.

    Other forms and lists of numbers are planted where a base span stands, and
    candidates of the new text are labelled by what was planted. Candidates of
    the text itself that may be personal data are left out.
    """
    random = np.random.default_rng([SEED, doc_id & 0xFFFFFFFF])
    rows = []

    def add(label: int, kind: str, left: str, body: str, right: str) -> None:
        rows.append((label, features(kind, left[-AROUND:], body, right[:AROUND])))

    def add_candidates(left: str, line: str, right: str, true: list[Span], kind: str) -> None:
        """True spans, and some of the candidates that meet the line and are none."""
        whole, shift = left + line + right, len(left)
        true = [(s + shift, e + shift) for s, e in true]
        layouts, wrong = [_layout(whole[s:e]) for s, e in true], []
        for own, start, end in candidates(whole):
            if own == kind and (start, end) in true:
                add(1, own, whole[:start], whole[start:end], whole[end:])
            elif start < shift + len(line) and end > shift:
                # By chance a run across two cards is a card, too.
                body = whole[start:end]
                if own != "card" or kind != "card" or not luhn(digits_of(body)) or _layout(body) not in layouts:
                    wrong.append((own, start, end))
        for i in random.permutation(len(wrong))[:WRONG_RUNS]:
            own, start, end = wrong[i]
            add(0, own, whole[:start], whole[start:end], whole[end:])

    base = base_spans(text)
    taken = _merged(span for spans in base.values() for span in spans)
    for kind, spans in base.items():
        for start, end in spans:
            body, left, right = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
            add(1, kind, left, body, right)
            same, unlike = _forms(kind, body, random)
            for other in same:
                line, true = _planted(kind, other, random)
                add_candidates(left, line, right, true, kind)
            for other in unlike:
                # Digits alone may be a phone after a word that says so.
                if kind != "phone" or not _hinted(kind, left) or NO_PHONE.fullmatch(other):
                    add(0, kind, left, other, right)
            if kind == "phone":
                add_candidates(left + "phone ", same[-1], right, [(0, len(same[-1]))], kind)
                add_candidates(left + "tel: ", digits_of(same[-1]), right, [(0, len(digits_of(same[-1])))], kind)
            numbers = " ".join(str(random.integers(1, 10 ** random.integers(1, 6))) for _ in range(8))
            add_candidates(left, numbers, right, [], "")
    for kind, start, end in candidates(text):
        if not _overlaps(taken, start, end):
            left, body, right = text[max(0, start - AROUND) : start], text[start:end], text[end : end + AROUND]
            if not doubtful(kind, left, body, right):
                add(0, kind, left, body, right)
    return rows


# --- boosted trees ------------------------------------------------------------


@dataclass
class Booster:
    """Trees of one depth: a feature and a cut per inner node, a value per leaf."""

    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray
    values: np.ndarray  # trees x leaves
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        each = np.arange(len(rows))
        for feature, cut, value in zip(self.features, self.cuts, self.values):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[each, feature[node]] > cut[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def boost(rows: np.ndarray, labels: np.ndarray) -> Booster:
    """Gradient boosting of the log loss, cuts at quantiles, Newton steps in the leaves."""
    inner = 2**DEPTH - 1
    quantiles = [np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 1)[1:-1])) for column in rows.T]
    rate = np.clip(labels.mean(), 0.01, 0.99)
    total = np.full(len(rows), np.log(rate / (1 - rate)))
    booster = Booster(
        np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1)), total[0]
    )
    for tree in range(TREES):
        chance = 1 / (1 + np.exp(-total))
        gradient, weight = labels - chance, chance * (1 - chance)
        node = np.zeros(len(rows), dtype=np.int64)
        for at in range(inner):
            own = np.flatnonzero(node == at)
            best = _best_cut(rows[own], gradient[own], weight[own], quantiles)
            if best:
                booster.features[tree, at], booster.cuts[tree, at] = best
            feature, cut = booster.features[tree, at], booster.cuts[tree, at]
            node[own] = 2 * at + 1 + (rows[own, feature] > cut)
        leaf = node - inner
        sums = np.bincount(leaf, gradient, inner + 1)
        booster.values[tree] = RATE * sums / (np.bincount(leaf, weight, inner + 1) + 1.0)
        total += booster.values[tree][leaf]
    return booster


def _best_cut(rows: np.ndarray, gradient: np.ndarray, weight: np.ndarray, quantiles: list[np.ndarray]):
    """The (feature, cut) that gains most, both sides of ``LEAST`` rows or more."""
    if len(rows) < 2 * LEAST:
        return None
    whole = gradient.sum() ** 2 / (weight.sum() + 1)
    best, gain = None, 1e-6
    for feature, cuts in enumerate(quantiles):
        place = np.searchsorted(cuts, rows[:, feature])  # rows above cut i have a place > i
        counts = np.bincount(place, minlength=len(cuts) + 1).cumsum()[:-1]
        g = np.bincount(place, gradient, len(cuts) + 1).cumsum()[:-1]
        h = np.bincount(place, weight, len(cuts) + 1).cumsum()[:-1]
        gains = g**2 / (h + 1) + (gradient.sum() - g) ** 2 / (weight.sum() - h + 1) - whole
        gains[(counts < LEAST) | (len(rows) - counts < LEAST)] = -np.inf
        if len(gains) and gains.max() > gain:
            gain, best = gains.max(), (feature, cuts[gains.argmax()])
    return best


@dataclass
class PiiModel:
    """Trees and the score from which a candidate of a kind is taken; no trees: base spans only."""

    booster: Booster | None
    thresholds: dict[str, float]

    def spans(self, text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
        """Base spans by kind, and all spans by kind."""
        base = base_spans(text)
        every = {kind: list(spans) for kind, spans in base.items()}
        if not self.booster:
            return base, every
        taken = _merged(span for spans in base.values() for span in spans)
        free = [each for each in candidates(text) if not _overlaps(taken, each[1], each[2])]
        added: list[tuple[float, str, int, int]] = []
        for at in range(0, len(free), SCORED):
            part = free[at : at + SCORED]
            rows = np.array(
                [features(k, text[max(0, s - AROUND) : s], text[s:e], text[e : e + AROUND]) for k, s, e in part], float
            )
            scores = self.booster.score(rows)
            added += [(-score, *each) for score, each in zip(scores, part) if score >= self.thresholds[each[0]]]
        chosen: list[Span] = []
        for _, kind, start, end in sorted(added):
            if not _overlaps(chosen, start, end):
                insort(chosen, (start, end))
                every[kind].append((start, end))
        return base, {kind: sorted(spans) for kind, spans in every.items()}


def _merged(spans: Iterable[Span]) -> list[Span]:
    """The stretches that spans cover, in order."""
    out: list[Span] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _overlaps(taken: list[Span], start: int, end: int) -> bool:
    """Whether a span meets one of the ordered stretches, which are apart from each other."""
    place = bisect_left(taken, (end,))
    return place > 0 and taken[place - 1][1] > start


def fit_pii(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_documents: int = FIT_DOCUMENTS,
    most_candidates: int = FIT_CANDIDATES,
) -> PiiModel:
    """Train on the candidates of a bounded sample of documents.

    About ``most_documents`` are dealt by a hash of the id, and of their
    candidates the first ``most_candidates`` in hash order are taken. A third of
    them is kept apart; a kind's threshold is the least score from which
    ``PRECISION`` of them are right, and ``LEAST_SCORE`` at least. Candidates that
    may be personal data are in neither part. Without candidates of both labels
    there are no trees.
    """
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).dropna()
    count = max(1, rows.count())
    part = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)

    def start():
        def propose(batch: pa.RecordBatch) -> dict:
            labels, own, places = [], [], []
            for place, (doc_id, text) in enumerate(zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())):
                for label, values in training_rows(doc_id, text):
                    labels.append(label)
                    own.append([float(value) for value in values])
                    places.append(place)
            return {"doc_id": batch["doc_id"].take(pa.array(places, pa.int64())), "label": labels, "row": own}

        return propose

    found = (
        map_batches(rows.filter(part < most_documents / count), start, "doc_id long, label int, row array<double>")
        .withColumn("order", F.xxhash64("doc_id", "label", "row"))
        .orderBy("order", "doc_id", "label")
        .limit(most_candidates)
        .collect()
    )
    labels = np.array([row["label"] for row in found])
    if not len(labels) or labels.min() == labels.max():
        return PiiModel(None, {})
    values = np.array([row["row"] for row in found])
    apart = np.array([row["order"] % 3 == 0 for row in found])
    booster = boost(values[~apart], labels[~apart])
    scores = booster.score(values)
    thresholds = {}
    for number, kind in enumerate(KINDS):
        own = apart & (values[:, 0] == number)
        thresholds[kind] = max(LEAST_SCORE, _threshold(scores[own], labels[own]))
    return PiiModel(booster, thresholds)


def _threshold(scores: np.ndarray, labels: np.ndarray, precision: float = PRECISION) -> float:
    """The least score from which ``precision`` of the candidates are right; above 1 if there is none."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    last = np.append(np.diff(scores[order]) != 0, True)[: len(order)]  # equal scores are taken together
    fitting = np.flatnonzero(last & (right >= precision))
    return float(scores[order[fitting[-1]]]) if len(fitting) else 2.0


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in KINDS for start, end in spans[kind])


def redact(text: str, spans: dict[str, list[Span]]) -> str:
    """Each stretch of overlapping spans becomes the name of its first kind."""
    out, done, until = [], 0, -1
    for start, end, kind in sorted((s, e, kind) for kind in KINDS for s, e in spans[kind]):
        if start >= until:
            out += [text[done:start], f"[{kind.upper()}]"]
            until = end
        until = max(until, end)
        done = until
    return "".join([*out, text[done:]])


def find_pii(
    documents: DataFrame, model: PiiModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Spans of every whole text: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are of base spans; ``spans`` has all. A null text
    is empty and has none. Repeated rows have the same result; no rows give
    none; null ids stay null; other columns are not looked at. Offsets are code points.
    """
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    given = documents.sparkSession.sparkContext.broadcast(model)

    def start():
        def find(batch: pa.RecordBatch) -> dict:
            found = [given.value.spans(text) for text in batch["text"].to_pylist()]
            return {
                "doc_id": batch["doc_id"],
                **{f"n_{kind}": [len(base[kind]) for base, _ in found] for kind in KINDS},
                "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                "spans": [joined(every) for _, every in found],
            }

        return find

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_batches(rows, start, f"doc_id long, {counts}, base_sha256 string, spans string")


def redact_pii(
    documents: DataFrame, model: PiiModel, *, text_col: str = "text", length_col: str | None = None
) -> DataFrame:
    """The documents with their spans replaced; all other columns as they are.

    ``length_col``, if given, gets the new number of code points where it was not null.
    """
    given, schema = documents.sparkSession.sparkContext.broadcast(model), documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if text is None else redact(text, given.value.spans(text)[1])
                for text in batch[text_col].to_pylist()
            ]
            columns = dict(zip(batch.schema.names, batch.columns))
            columns[text_col] = pa.array(texts, batch.schema.field(text_col).type)
            if length_col:
                old = batch[length_col].to_pylist()
                new = [o if o is None or t is None else len(t) for o, t in zip(old, texts)]
                columns[length_col] = pa.array(new, batch.schema.field(length_col).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return documents.mapInArrow(run, schema)
