"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers.  The field labels
tokens that hold a digit or an at sign; all other tokens are outside by definition.  Neighbouring
tokens share a potential, and so do distant tokens of one document that repeat each other or end
in the same digits, by themselves or as groups of one number.  Loopy belief propagation settles the labels; what a pattern has found is
clamped.  So a number found once in full is also found where it is repeated in part.  The field is
trained here, by pseudo-likelihood on generated sentences with known labels.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Container, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

KINDS = ("email", "ip", "card", "phone")
OUT = 0
Span = tuple[str, int, int]

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
MARK = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(x)] for x in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                yield start, m.end()
                done = m.end()
        at = text.find("@", at + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) by patterns, in code points; in order of kind and start.

    Each pattern is matched in time proportional to the text, whatever the text.
    """
    if not MARK.search(text):
        return []
    found = [("email", *x) for x in _emails(text)] + [("ip", *x) for x in _ips(text)]
    for m in _DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() <= 64 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(re.findall("[0-9]", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


# --- the field ---------------------------------------------------------------------------------

CUES = {
    "email": "mail email e-mail write contact address courriel correo",
    "ip": "ip host server address from login",
    "card": "card visa credit pay account carte tarjeta karte",
    "phone": "phone call tel telephone mobile fax cell ring number",
}
CUE = {w: k for k, ws in CUES.items() for w in ws.split()}
FEATURES = ["bias", "at", "at_dotted", "plus", "open", "close", "dots3", "dots3_big", "digits16", "digits16_luhn", "digits7", "digits4", "digits3", "digits2", "digits10", "long", "letters", "dash", "hex", "year", *(f"cue_{k}" for k in KINDS)]
_AT = {f: i for i, f in enumerate(FEATURES)}


def features(token: str, before: str) -> list[int]:
    """The numbers of the features that hold for a token and the one before it."""
    digits = re.sub("[^0-9]", "", token)
    core = token.strip(".,;:!?\"'*#%$&<>[]{}|")
    hexadecimal = bool(re.fullmatch(r"\W*[0-9a-fA-F]{20,}\W*", core))
    n, on = 0 if hexadecimal else len(digits), ["bias"]
    on += ["at"] * ("@" in token) + ["at_dotted"] * bool(re.search(r"@[^@]+\.", token))
    on += ["plus"] * token.startswith("+") + ["open"] * token.startswith("(") + ["close"] * core.endswith(")")
    parts = core.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        on.append("dots3" if all(len(p) < 4 and int(p) < 256 for p in parts) else "dots3_big")
    if 16 <= n <= 19:
        on.append("digits16_luhn" if luhn(digits) else "digits16")
    on += ["digits7"] * (n == 7) + ["digits3"] * (n == 3) + ["digits4"] * (n == 4) + ["digits2"] * (n == 2) + ["digits10"] * (8 <= n <= 15) + ["long"] * (n > 19)
    on += ["letters"] * bool(re.search("[A-Za-z]", core)) + ["dash"] * ("-" in core)
    on += ["hex"] * hexadecimal + ["year"] * bool(re.fullmatch("(19|20)[0-9]{2}", core))
    if (k := CUE.get(before.lower().strip(".,;:!?\"'"))) is not None:
        on.append(f"cue_{k}")
    return [_AT[f] for f in on]


_NUMBER = re.compile(r"\W*[0-9][0-9().+-]*\W*")
_STOP = re.compile(r"[.,;:!?]\W*$")


def number_runs(tokens: list[str], at: list[int]) -> list[list[int]]:
    """Runs of adjacent candidates that are groups of figures; punctuation ends a run."""
    runs: list[list[int]] = []
    ended = True
    for i, t in enumerate(tokens):
        if not _NUMBER.fullmatch(t):
            ended = True
            continue
        if ended or at[i] != at[i - 1] + 1 or t[0] == "+":
            runs.append([])
        runs[-1].append(i)
        ended = bool(_STOP.search(t))
    return runs


def links(tokens: list[str], at: list[int], known: Container[int] = ()) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain and skip links among candidates; at has their places among all tokens.

    A key is an address, the figures of a token, or the last seven figures of a token or of a run of
    groups; of runs with one key the groups are joined from the last on, as far as their figures
    agree.  Repeats of a key are joined each to the first known one, so that none is far from the
    evidence; if none is known, each to the next one.  So a token has one link a key at most.
    """
    chain = [(i, i + 1) for i in range(len(at) - 1) if at[i + 1] == at[i] + 1]
    skip, places = set(), {}
    figures = [re.sub("[^0-9]", "", t) for t in tokens]
    for i, t in enumerate(tokens):
        own = []
        if "@" in t:
            own.append(("a", t.lower().strip(".,;:!?()\"'<>[]")))
        elif len(figures[i]) >= 7:
            own += [("d", figures[i]), ("e", figures[i][-7:])]
        for key in own:
            places.setdefault(key, []).append([i])
    for run in number_runs(tokens, at):
        whole = "".join([figures[i] for i in run])
        if len(run) > 1 and len(whole) >= 7:
            places.setdefault(("r", whole[-7:]), []).append(run[::-1])
    for same in places.values():
        hub = next((x for x in same if any(i in known for i in x)), None)
        for x, y in zip(same, same[1:]) if hub is None else ((hub, x) for x in same if x is not hub):
            for i, j in zip(x, y):
                if len(x) > 1 and figures[i] != figures[j]:
                    break
                skip.add((min(i, j), max(i, j)))
    return chain, sorted(skip - set(chain))


class Field:
    """Weights of token features, chain links and skip links for the labels outside and KINDS."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, feats: list[list[int]], chain: list[tuple[int, int]], skip: list[tuple[int, int]], clamped: dict[int, int], rounds: int = 2000, damp: float = 0.3) -> np.ndarray:
        """Label probabilities of each candidate after loopy belief propagation.

        Messages pass until they settle; rounds only ends those that never do.  No message changes
        a clamped label, however many there are.
        """
        labels = self.unary.shape[1]
        score = np.array([self.unary[f].sum(0) for f in feats]).reshape(-1, labels)
        for i, y in clamped.items():
            score[i] = -60.0
            score[i, y] = 0.0
        edges = np.array([*chain, *skip], np.int64).reshape(-1, 2)
        if len(edges):
            pair = np.concatenate([np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)])
            src, dst = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
            pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
            back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
            message = np.zeros((len(src), labels))
            free = np.ones(len(score), bool)
            free[list(clamped)] = False
            keep = free[dst][:, None]  # what goes to a clamped label is not heard
            for _ in range(rounds):
                belief = score.copy()
                np.add.at(belief, dst, message)
                x = (belief[src] - message[back])[:, :, None] + pair
                new = np.logaddexp.reduce(x, axis=1)
                new = np.where(keep, new - new.max(1, keepdims=True), 0.0)
                new = damp * message + (1 - damp) * new
                settled = np.abs(new - message).max() < 1e-4
                message = new
                if settled:
                    break
            np.add.at(score, dst, message)
        p = np.exp(score - score.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def generated(seed: int, texts: int = 600) -> Iterator[tuple[list[str], list[int]]]:
    """Token lists with labels: personal data in full and in part, and numbers that are none."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8)))

    def card() -> str:
        body = digits(15)
        return next(body + c for c in "0123456789" if luhn(body + c))

    for _ in range(texts):
        out: list[tuple[str, int]] = []
        say = lambda *t, y=0: out.extend((x, y) for x in t)
        for _ in range(rng.randint(1, 5)):
            kind = rng.choice((*KINDS, "none", "none"))
            say(*(word() for _ in range(rng.randint(1, 6))))
            if kind != "none" and rng.random() < 0.3:
                say(rng.choice(CUES[kind].split()))
            y = KINDS.index(kind) + 1 if kind != "none" else 0
            if kind == "phone" and rng.random() < 0.5:
                groups = [digits(rng.choice((2, 3, 4))), digits(rng.choice((3, 4))), digits(4)] if rng.random() < 0.6 else [digits(rng.choice((7, 9, 10)))]
                say("+" + digits(rng.choice((1, 2))), *groups, y=y)
                for _ in range(rng.randint(0, 2)):
                    say(*(word() for _ in range(3)))
                    say(*(groups if rng.random() < 0.5 or len("".join(groups[1:])) < 7 else groups[1:]), y=y)
            elif kind == "phone":
                area, local = f"({digits(3)})", f"{digits(3)}-{digits(4)}"
                say("+" + digits(1), area, local, y=y)
                for _ in range(rng.randint(0, 2)):
                    say(*(word() for _ in range(3)))
                    say(*rng.choice(((area, local), (local,))), y=y)
            elif kind == "email":
                x = f"{word()}.{digits(2)}@{word()}{digits(1)}.example.{rng.choice(('com', 'org'))}"
                say(x, y=y)
                if rng.random() < 0.3:
                    say(word(), x.upper(), y=0)
                    out[-1] = (x.upper(), y)
            elif kind == "ip":
                x = ".".join(str(rng.randint(0, 255)) for _ in range(4))
                for _ in range(rng.randint(1, 2)):
                    say(x, y=y)
                    say(word())
            elif kind == "card":
                x = card()
                if rng.random() < 0.4:
                    groups = [x[i : i + 4] for i in range(0, 16, 4)]
                    say(*groups, y=y)
                    say(word(), word())
                    if rng.random() < 0.6:
                        say(*(groups if rng.random() < 0.5 else groups[2:]), y=y)
                    continue
                say(x, y=y)
                if rng.random() < 0.4:
                    say(word(), word())
                    say(rng.choice(("x" * 9 + x[9:], x[rng.randint(4, 9) :])), y=y)
            else:
                say(rng.choice((digits(4), str(rng.randint(1900, 2030)), digits(16), f"{digits(1)}.{digits(1)}.{digits(1)}", f"({digits(3)})", f"{digits(3)}-{digits(4)}", digits(7), digits(3), digits(11), digits(2), f"{digits(2)},{digits(3)}", str(int(hashlib.sha1(digits(9).encode()).hexdigest(), 16))[:40], hashlib.sha1(digits(9).encode()).hexdigest(), f"{word()}@{word()}", ".".join(digits(4) for _ in range(4)))))
            say(word())
        yield [t for t, _ in out], [y for _, y in out]


@lru_cache(1)
def trained(seed: int = 7, rounds: int = 1200, rate: float = 2.0, decay: float = 1e-4) -> Field:
    """Weights by gradient ascent on the pseudo-likelihood of generated texts."""
    k = len(KINDS) + 1
    rows, near, far, truth = [], [], [], []
    for tokens, labels in generated(seed):
        at = [i for i, t in enumerate(tokens) if MARK.search(t)]
        own = [tokens[i] for i in at]
        chain, skip = links(own, at)
        c, s = np.zeros((len(at), k)), np.zeros((len(at), k))
        y = [labels[i] for i in at]
        for to, pairs in ((c, chain), (s, skip)):
            for i, j in pairs:
                to[i, y[j]] += 1
                to[j, y[i]] += 1
        for i, t in zip(at, own):
            x = np.zeros(len(FEATURES))
            x[features(t, tokens[i - 1] if i else "")] = 1
            rows.append(x)
        near.append(c)
        far.append(s)
        truth += y
    x, c, s, y = np.array(rows), np.concatenate(near), np.concatenate(far), np.eye(k)[truth]
    w, wc, ws = np.zeros((x.shape[1], k)), np.zeros((k, k)), np.zeros((k, k))
    for _ in range(rounds):
        z = x @ w + c @ wc + s @ ws
        p = np.exp(z - z.max(1, keepdims=True))
        g = (y - p / p.sum(1, keepdims=True)) / len(y)
        w += rate * (x.T @ g - decay * w)
        for m, n in ((wc, c), (ws, s)):
            d = n.T @ g
            m += rate * ((d + d.T) / 2 - decay * m)
    return Field(w, wc, ws)


_EDGE = ".,;:!?\"'*#%$&<>[]{}|"


def added_spans(text: str, base: list[Span], field: Field, sure: float = 0.9) -> list[Span]:
    """Spans that the field adds to those of the patterns; none overlaps one of these."""
    places = [m.span() for m in TOKEN.finditer(text)]
    at = [i for i, (a, b) in enumerate(places) if MARK.search(text, a, b)]
    tokens = [text[slice(*places[i])] for i in at]
    if not tokens:
        return []
    clamped: dict[int, int] = {}
    order = sorted(base, key=lambda s: s[1])
    starts = np.array([places[i][0] for i in at])
    ends = np.array([places[i][1] for i in at])
    for kind, a, b in order:
        for j in range(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))):
            clamped.setdefault(j, KINDS.index(kind) + 1)
    chain, skip = links(tokens, at, clamped)
    p = field.marginals([features(t, text[slice(*places[i - 1])] if i else "") for i, t in zip(at, tokens)], chain, skip, clamped)
    found: list[Span] = []
    run: tuple[int, int, int] | None = None  # label, first, last
    for j, (best, top) in enumerate(zip(p.argmax(1).tolist(), p.max(1).tolist())):
        y = best if top >= sure and j not in clamped else OUT
        if run and y == run[0] and KINDS[y - 1] in ("card", "phone") and at[j] == at[run[2]] + 1 and not _STOP.search(tokens[run[2]]):
            run = (y, run[1], j)
            continue
        if run:
            found.append(_trimmed(text, KINDS[run[0] - 1], places[at[run[1]]][0], places[at[run[2]]][1]))
        run = (y, j, j) if y else None
    if run:
        found.append(_trimmed(text, KINDS[run[0] - 1], places[at[run[1]]][0], places[at[run[2]]][1]))
    return [s for s in found if s[1] < s[2]]


def _trimmed(text: str, kind: str, a: int, b: int) -> Span:
    while b > a and text[b - 1] in _EDGE:
        b -= 1
    while a < b and text[a] in _EDGE:
        a += 1
    return kind, a, b


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(spans of the patterns, all spans), each in order of kind and start."""
    if not MARK.search(text):
        return [], []
    base = base_spans(text)
    more = added_spans(text, base, field)
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1])) if more else base


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, masked string"


def _batches(field: Field, with_masked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                text = t.as_py() or ""
                base, spans = all_spans(text, field)
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), masked(text, spans) if with_masked else None))
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[x.split()[0] for x in FOUND.split(", ")])

    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None, with_masked: bool = False) -> DataFrame:
    """Counts and spans for each row of docs, and the masked text if wanted.

    n_* and base_sha256 are of the patterns' spans, spans is of all.  Null texts are empty; ids
    may be null or repeat; equal texts have equal spans; other columns are not looked at.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(_batches(field or trained(), with_masked), FOUND)


def mask_texts(docs: DataFrame, text_col: str = "text", chars_col: str | None = None, field: Field | None = None) -> DataFrame:
    """docs with the texts masked, and chars_col, if given, counted anew.

    Null texts stay null and empty ones empty; equal texts are masked alike; rows and all other
    columns stay as they are.
    """
    field = field or trained()
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [None if t is None else masked(t, all_spans(t, field)[1]) for t in batch.column(at).to_pylist()]
            cols = list(batch.columns)
            cols[at] = pa.array(new, cols[at].type)
            if chars_col:
                i = names.index(chars_col)
                cols[i] = pa.array([None if t is None else len(t) for t in new], cols[i].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op4_pii_crf(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).drop("masked")
