"""Personal data in texts: patterns, and a skip-chain conditional random field that carries their labels to damaged mentions.

`base_spans` finds email addresses, IP addresses, card and phone numbers by fixed patterns.  In a document that holds such a
span every other word with a digit or an at sign is a variable of the field, with the labels none, email, ip, card and phone; a
word without either is no part of personal data.  Factors of the field:

* features of the word's form;
* chain: two words without another between them;
* skip: two words, or a word and a span, however distant, that are equal or similar (`_keys`).

Base spans are observed.  Loopy sum-product messages are passed over all documents of a batch at once until they settle; words with a marginal of
`MARGINAL` or more become spans.  Members of a group of equal or similar words are linked to the group's first observed span
and to the member before them, so edges are linear in the words.

The weights are learned by pseudo-likelihood from a sample of the corpus: at most `TRAIN_SPANS` base spans and
`TRAIN_WORDS` other words (spans and words over `TRAIN_CHARS` characters are not sampled).  A span's text is damaged (signs
lost or replaced, a character dropped); beside its whole twin the damaged words carry the twin's label, alone they carry none.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.llm.common import narrowed, slices, small_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_SPANS, TRAIN_WORDS, TRAIN_CHARS = 4_000, 4_000, 200
MARGINAL = 0.9
#: Messages are settled when none moves by more than SETTLED; a field with frustrated loops stops after SWEEPS.
SETTLED, SWEEPS = 1e-4, 200
SAME, FORM, PART, NEAR = range(4)

# The patterns of the four kinds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_BLANKS = " \t\n\r\x0b\x0c"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OPEN = re.compile(r"[0-9@]|[(\[]at[)\]]")
_EDGE = ".,;:!?\"'`*#$%&|<>{}=~^_"
_DIGITS = re.compile(r"[^0-9]+")
_PLAIN = re.compile(r"[^0-9a-z]+")
_AT, _DOT = re.compile(r"[(\[]at[)\]]"), re.compile(r"[(\[](?:dot|\.)[)\]]|,")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Each at sign with a domain takes the name characters before it; linear in any text, unlike a search from each character."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        m, after = _DOMAIN.match(text, at + 1), at + 1
        if m:
            start = at
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                floor = after = m.end()
                out.append((start, floor))
        at = text.find("@", after)
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """(start, end) in code points of each kind's matches, leftmost first; a match that fails its kind's check is dropped."""
    def count(m: re.Match) -> int:
        return len(_DIGITS.sub("", m.group()))

    return {
        "email": _emails(text),
        "ip": [m.span() for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))],
        "card": [m.span() for m in _CARD.finditer(text) if 16 <= count(m) <= 19 and luhn(_DIGITS.sub("", m.group()))],
        "phone": [m.span() for m in _PHONE.finditer(text) if 8 <= count(m) <= 15],
    }


def open_words(text: str) -> list[tuple[int, int, int]]:
    """(start, end, start of the whole word) of all words with a digit or an at sign, without signs at their edges."""
    out, end = [], 0
    for m in _OPEN.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and text[start - 1] not in _BLANKS:
            start -= 1
        end = _WORD.match(text, m.start()).end()
        word = text[start:end]
        left = start + len(word) - len(word.lstrip(_EDGE))
        right = end - (len(word) - len(word.rstrip(_EDGE)))
        if left < right:
            out.append((left, right, start))
    return out


def _keys(text: str) -> Iterator[tuple[int, str]]:
    """What a word or span shares with those equal (SAME) or similar to it: its letters and digits (FORM), the last seven digits of a
    number or the name and first domain label of an address (PART), its letters and digits but for one (NEAR, from 8 to 40 of them)."""
    low = text.lower()
    yield SAME, low
    plain_at = _DOT.sub(".", _AT.sub("@", low))
    skeleton, digits = _PLAIN.sub("", plain_at), _DIGITS.sub("", low)
    if len(skeleton) >= 7:
        yield FORM, skeleton
    if len(digits) >= 7 and len(digits) == len(skeleton):
        yield PART, digits[-7:]
    elif "@" in plain_at:
        name, _, domain = plain_at.rpartition("@")
        part = name + "@" + domain.partition(".")[0]
        if len(part) >= 5:
            yield PART, part
    if 8 <= len(skeleton) <= 40:
        yield from ((NEAR, k) for k in {skeleton, *(skeleton[:i] + skeleton[i + 1:] for i in range(len(skeleton)))})


def _features(word: str) -> list[float]:
    digits = _DIGITS.sub("", word)
    n, low = len(digits), word.lower()
    checked = 16 <= n <= 19
    return [1.0, n == 0, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 15, checked, n > 19, "@" in word or bool(_AT.search(low)),
            word.count(".") >= 2, "(" in word or ")" in word, word[0] == "+", bool(re.search("[a-z]", low)),
            checked and not luhn(digits), "-" in word or "/" in word]


N_FEATURES = len(_features("0"))


class Weights:
    """Weights of the field: form features by label, chain by label, skip by kind of link and label (both ends having that label)."""

    def __init__(self):
        self.form = np.zeros((N_FEATURES, len(LABELS)))
        self.chain = np.zeros(len(LABELS))
        self.skip = np.zeros((4, len(LABELS)))


# --- learning -------------------------------------------------------------------------------------------------------------

def _damaged(kind: str, span: str, rnd: random.Random) -> str:
    """The span with its signs lost or replaced, or a character dropped."""
    digits = _DIGITS.sub("", span)
    if rnd.random() < 0.2 and kind != "email":
        i = rnd.randrange(len(span))
        return span[:i] + span[i + 1:]
    if kind == "email":
        name, domain = span.rsplit("@", 1)
        return rnd.choice([f"{name}(at){domain}", f"{name}[at]{domain}", span.replace(".", ","), f"{name}@{domain.split('.')[0]}",
                           name + "@" + domain.replace(".", "(dot)"), name[:-1] + "(at)" + domain])
    if kind == "ip":
        return span.replace(".", rnd.choice(["-", "[.]", "(dot)", "/", ","]))
    if kind == "card":
        return rnd.choice(["/", ".", "_"]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    rest = span.lstrip("+0123456789").strip()
    return rnd.choice([span[1:], digits, rest or digits, "/".join((digits[:-7], digits[-7:-4], digits[-4:]))])


def _examples(spans: list[tuple[str, str]], words: list[str], seed: int = 1):
    """Training rows (features, chain counts by label, skip counts by link and label, label)."""
    rnd = random.Random(seed)
    form, chain, skip, label = [], [], [], []

    def add(word, neighbours, links, y):
        form.append(_features(word))
        chain.append([neighbours.count(k) for k in range(len(LABELS))])
        counts = np.zeros((4, len(LABELS)))
        for link, k in links:
            counts[link, k] += 1
        skip.append(counts)
        label.append(y)

    for kind, span in spans:
        y = LABELS.index(kind)
        damaged = _damaged(kind, span, rnd)
        if any(base_spans(damaged).values()):
            continue
        parts = [damaged[a:b] for a, b, _ in open_words(damaged)]
        own = set(_keys(span))
        for with_twin in (True, False):
            here = y if with_twin else 0
            for i, w in enumerate(parts):
                links = sorted(link for link, k in _keys(w) if (link, k) in own) if with_twin else []
                # neighbours are as uncertain as the word itself, so half of the examples don't know theirs
                near = [here] * ((i > 0) + (i + 1 < len(parts))) if rnd.random() < 0.5 else []
                add(w, near, [(links[0], y)] if links else [], here if links or near else 0)
                if links:
                    add(w, near, [(SAME, y)], y)  # the same damage once more
    for w in words:
        add(w, [0] * rnd.randrange(3), [(SAME, 0)] * rnd.randrange(2), 0)
    return (np.array(form, dtype=float).reshape(-1, N_FEATURES), np.array(chain, dtype=float).reshape(-1, len(LABELS)),
            np.array(skip, dtype=float).reshape(-1, 4, len(LABELS)), np.array(label, dtype=int))


def fit(spans: list[tuple[str, str]], words: list[str], steps: int = 1000, rate: float = 1.0, ridge: float = 1e-3) -> Weights:
    """Weights of greatest penalised pseudo-likelihood, by gradient steps; links and chains never repel (weights at least 0)."""
    w = Weights()
    form, chain, skip, label = _examples(spans, words)
    if not len(label):
        w.form[0, 0] = 10.0
        return w
    target = np.eye(len(LABELS))[label]
    weight = 1 / np.bincount(label, minlength=len(LABELS)).clip(1)[label]
    weight = (weight / weight.sum())[:, None]
    for _ in range(steps):
        score = form @ w.form + chain * w.chain + np.einsum("nkl,kl->nl", skip, w.skip)
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (target - p) * weight * len(LABELS)
        w.form += rate * (form.T @ g - ridge * w.form)
        w.chain = np.maximum(0, w.chain + rate * ((chain * g).sum(axis=0) - ridge * w.chain))
        w.skip = np.maximum(0, w.skip + rate * (np.einsum("nkl,nl->kl", skip, g) - ridge * w.skip))
    return w


def learn(docs: DataFrame) -> Weights:
    """Weights from a sample of the base spans and other words of all texts, first by a hash of document and place."""
    small_batches(docs.sparkSession)

    def take(batches):
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text or not _OPEN.search(text):
                    continue
                base = base_spans(text)
                rows += [(doc_id, a, kind, text[a:b]) for kind in KINDS for a, b in base[kind] if b - a <= TRAIN_CHARS]
                taken = _covered(base)
                rows += [(doc_id, a, None, text[a:b]) for a, b, _ in open_words(text) if b - a <= TRAIN_CHARS and not taken(a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                             names=["doc_id", "at", "kind", "part"])

    found = narrowed(docs, doc_id="long", text="string").mapInArrow(take, "doc_id long, at long, kind string, part string")
    found = found.withColumn("key", F.xxhash64("doc_id", "at", "part"))
    columns = [F.col("kind").isNotNull().alias("whole"), "key", "part", "kind"]
    # both samples in one pass: each keeps its first rows by the key
    rows = found.select(*columns)
    spans = rows.where("whole").orderBy("key", "part", "kind").limit(TRAIN_SPANS)
    words = rows.where("NOT whole").orderBy("key", "part").limit(TRAIN_WORDS)
    got = spans.unionByName(words).collect()
    return fit(sorted((r.kind, r.part) for r in got if r.whole), sorted(r.part for r in got if not r.whole))


# --- inference ------------------------------------------------------------------------------------------------------------

def _covered(base: dict[str, list[tuple[int, int]]]):
    """Whether a stretch of text overlaps a base span, asked in ascending order."""
    spans = sorted(s for found in base.values() for s in found)
    at, reach = 0, 0

    def asked(a: int, b: int) -> bool:
        nonlocal at, reach
        while at < len(spans) and spans[at][0] < b:
            reach = max(reach, spans[at][1])
            at += 1
        return reach > a

    return asked


def marginals(unary: np.ndarray, edges: np.ndarray, coupling: np.ndarray) -> np.ndarray:
    """Label probabilities by loopy sum-product: ``unary`` log scores (nodes x labels), ``edges`` (n x 2), ``coupling``
    (edges x labels), the log factor of both ends having that label."""
    n, e = len(unary), len(edges)
    if e:
        src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        back = np.concatenate([np.arange(e, 2 * e), np.arange(e)])
        gain = np.expm1(np.concatenate([coupling, coupling]))
        messages = np.zeros((2 * e, unary.shape[1]))
    belief = unary
    for _ in range(SWEEPS if e else 0):
        given = belief[src] - messages[back]
        given = np.exp(given - given.max(axis=1, keepdims=True))
        new = np.log(given.sum(axis=1, keepdims=True) + given * gain)
        new = 0.5 * messages + 0.5 * (new - new.min(axis=1, keepdims=True))
        moved = np.abs(new - messages).max()
        messages = new
        belief = unary + np.stack([np.bincount(dst, messages[:, k], minlength=n) for k in range(unary.shape[1])], axis=1)
        if moved < SETTLED:
            break
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


class Field:
    """The random fields of a batch's documents, as one graph."""

    def __init__(self, weights: Weights):
        self.w = weights
        self.words: list[tuple[int, int, int]] = []  # (document, start, end)
        self.unary: list[np.ndarray] = []
        self.edges: list[tuple[int, int]] = []
        self.coupling: list[np.ndarray] = []

    def add(self, number: int, text: str, base: dict[str, list[tuple[int, int]]]) -> None:
        """The open words of a document, its observed spans and all links."""
        taken = _covered(base)
        words = [(a, b) for a, b, _ in open_words(text) if not taken(a, b)]
        if not words:
            return
        first = len(self.words)
        self.words += [(number, a, b) for a, b in words]
        scores = np.array([_features(text[a:b]) for a, b in words], dtype=float) @ self.w.form
        self.unary.append(scores)
        observed: dict[tuple, int] = {}
        for k, kind in enumerate(KINDS, 1):
            for a, b in base[kind]:
                for key in _keys(text[a:b]):
                    observed.setdefault(key, k)
        # chain: neighbours with nothing but blanks and edge signs between them
        begins = {a: k for k, kind in enumerate(KINDS, 1) for a, _ in base[kind]}
        stops = {b: k for k, kind in enumerate(KINDS, 1) for _, b in base[kind]}
        linked, last = set(), {}
        for i, (a, b) in enumerate(words):
            left, right = _skip_back(text, a), _skip_on(text, b)
            for k in (stops.get(left), begins.get(right)):
                if k:
                    scores[i, k] += self.w.chain[k]
            if i and words[i - 1][1] == left:
                self._edge(first + i - 1, first + i, self.w.chain)
                linked.add((i - 1, i))
            seen: dict[int, int] = {}
            best = None
            for link, key in _keys(text[a:b]):
                if best is None and (link, key) in observed:
                    best = (link, observed[link, key])  # keys come strongest first
                j = last.get((link, key))
                if j is not None and j not in seen:
                    seen[j] = link
                last[link, key] = i
            if best:
                scores[i, best[1]] += self.w.skip[best]
            for j, link in seen.items():
                if (j, i) not in linked:
                    self._edge(first + j, first + i, self.w.skip[link])

    def _edge(self, i: int, j: int, coupling: np.ndarray) -> None:
        self.edges.append((i, j))
        self.coupling.append(coupling)

    def spans(self) -> list[tuple[int, int, int, int]]:
        """(document, label, start, end) of the words that the field labels, neighbours of one label not yet joined to one span."""
        if not self.words:
            return []
        p = marginals(np.concatenate(self.unary), np.array(self.edges, dtype=np.int64).reshape(-1, 2), np.array(self.coupling).reshape(-1, len(LABELS)))
        best = p[:, 1:].argmax(axis=1) + 1
        sure = np.flatnonzero(p[np.arange(len(p)), best] >= MARGINAL)
        return [(self.words[i][0], int(best[i]), *self.words[i][1:]) for i in sure.tolist()]


_PASS = frozenset(_BLANKS + _EDGE)


def _skip_back(text: str, at: int) -> int:
    while at > 0 and text[at - 1] in _PASS:
        at -= 1
    return at


def _skip_on(text: str, at: int) -> int:
    while at < len(text) and text[at] in _PASS:
        at += 1
    return at


def find_spans(texts: list[str], weights: Weights) -> list[tuple[dict, list[tuple[str, int, int]]]]:
    """For each text its base spans and all spans (kind, start, end) by kind and start."""
    field, base = Field(weights), []
    for number, text in enumerate(texts):
        found = base_spans(text) if _OPEN.search(text) else {k: [] for k in KINDS}
        base.append(found)
        if any(found.values()):
            field.add(number, text, found)
    more: list[list] = [[] for _ in texts]
    for number, label, a, b in field.spans():
        had = more[number]
        if had and had[-1][0] == label and not texts[number][had[-1][2]:a].strip(_BLANKS):
            had[-1] = (label, had[-1][1], b)
        else:
            had.append((label, a, b))
    return [(found, [(kind, a, b) for k, kind in enumerate(KINDS, 1)
                     for a, b in sorted(found[kind] + [(a, b) for label, a, b in extra if label == k])])
            for found, extra in zip(base, more)]


def personal_data(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Rows (doc_id, base, spans), both arrays of (kind, start, stop) by kind (email, ip, card, phone) and start, in code points.

    ``base`` are the patterns' matches, ``spans`` these and what the field adds; without ``weights`` they are learned from ``docs``.
    Null and empty texts have no spans.  Each row is a document of its own: repeated rows and ids give equal rows, null ids are kept.
    A text of any length is one document; extra columns are ignored; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    weights = weights or learn(docs)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def find(batches):
        for batch in slices(batches, "text"):
            found = find_spans([t or "" for t in batch.column("text").to_pylist()], weights)
            rows = [[[dict(kind=k, start=a, stop=b) for k in KINDS for a, b in base[k]] for base, _ in found],
                    [[dict(kind=k, start=a, stop=b) for k, a, b in spans] for _, spans in found]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(r, pa.list_(span)) for r in rows)], names=["doc_id", "base", "spans"])

    spans = "array<struct<kind:string,start:long,stop:long>>"
    return narrowed(docs, doc_id="long", text="string").mapInArrow(find, f"doc_id long, base {spans}, spans {spans}")
