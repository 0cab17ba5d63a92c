"""Personal data: exact patterns, and a linear-chain conditional random field beside them.

The patterns find e-mail addresses, IP addresses, card and phone numbers in their
plain forms. The field adds other written forms (phones without a plus sign, IP
addresses of version 6, addresses without a dotted host ...). Its labels are O and
B/I of each kind; its features are word shapes, digit groups, checks of the digits
and the words around. Only tokens with a digit or @ can have a label other than O,
so a text falls into runs of such tokens: each run is decoded on its own, exactly,
and runs of one length together, by Viterbi in numpy. The field is trained by
likelihood on a small labelled table, which ``labelled_rows`` makes from a seed. A
span of the field counts if its digits can be of its kind and if it meets no span of
the patterns; theirs stay as they are.

Cases: null and empty texts have no spans; places are code points, the end exclusive;
texts of any length and with any characters are searched whole; bytes that aren't UTF-8
are U+FFFD; an empty table gives an empty result; repeated rows are rows of their own;
further columns don't matter, whatever their names.
"""

from __future__ import annotations

import ipaddress
import random
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.llm.store import whole_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: What the contract's patterns ask for. An address is found from its @,
#: and an IP address from the first digit of a run, so that long runs take linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: Rows and seed of the labelled table, and steps and strength of the training.
ROWS, SEED, STEPS, RATE, PENALTY = 1500, 11, 120, 0.15, 1e-3

Span = tuple[int, int, int]  # place of the kind in KINDS, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by start and kind."""
    out: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if TRIGGER.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if 12 <= m.end() - m.start() and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], s[0]))


def shape(token: str) -> str:
    """Letters as a or A, digits as d, runs shortened; other characters as they are."""
    out: list[str] = []
    for c in token:
        s = "d" if c in "0123456789" else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)


def groups(token: str) -> str:
    return "-".join(str(len(g)) for g in re.findall("[0-9]+", token))


def features(tokens: list[str], k: int) -> list[str]:
    """Of token k among the tokens of its line."""
    t = tokens[k]
    core = t.strip(".,;:!?()[]{}<>\"'")
    before = tokens[k - 1] if k else "^"
    after = tokens[k + 1] if k + 1 < len(tokens) else "$"
    d = digits_of(t)
    near = lambda w: w.strip(".,;:!?()\"'").lower() if not TRIGGER.search(w) else shape(w)
    out = [
        "bias", f"s={shape(t)}", f"c={shape(core)}", f"g={groups(t)}", f"n={min(len(d), 20)}", f"b={near(before)}", f"a={near(after)}",
        f"bg={groups(before)}|{groups(t)}", f"ag={groups(t)}|{groups(after)}", f"at={t.count('@')}", f"p={t[:1]}" if not t[:1].isalnum() else "p=w",
    ]
    if 12 <= len(d) <= 19:
        out.append(f"luhn={luhn(d)}")
    if d == core and len(d) == 4:  # one of four groups of a card's digits
        fours = [k - i for i in range(4) if k - i >= 0 and k - i + 4 <= len(tokens)]
        parts = [[w.strip(".,;:!?()") for w in tokens[a : a + 4]] for a in fours]
        out.append(f"four={any(all(len(w) == 4 and w.isascii() and w.isdigit() for w in p) and luhn(''.join(p)) for p in parts)}")
    if ":" in core:
        out.append(f"six={is_ip(core)}")
    return out


def is_ip(s: str) -> bool:
    try:
        ipaddress.ip_address(s)
    except ValueError:
        return False
    return True


def labelled_rows(rows: int = ROWS, seed: int = SEED) -> list[tuple[list[str], list[str]]]:
    """The labelled table: tokens of a line, and their labels. Made from a seed by rule."""
    rng = random.Random(seed)
    syllables = "an be co de el fi ga ho in ja ko la me no or pa qui ra so ta un ve wi ya zo".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    lead = lambda: rng.choice("23456789") + num(2)

    def card(valid: bool) -> str:
        body = rng.choice("3456") + num(14)
        good = next(c for c in "0123456789" if luhn(body + c))
        return body + (good if valid else rng.choice([c for c in "0123456789" if c != good]))

    four = lambda s, sep: sep.join(s[i : i + 4] for i in range(0, 16, 4))
    phone = [
        lambda: f"({lead()}) {lead()}-{num(4)}", lambda: f"{lead()}-{lead()}-{num(4)}", lambda: f"{lead()}.{lead()}.{num(4)}", lambda: f"1-{lead()}-{lead()}-{num(4)}",
        lambda: f"{lead()} {lead()} {num(4)}", lambda: f"({lead()}){lead()}-{num(4)}", lambda: f"+{rng.randint(1, 99)} ({lead()}) {lead()}-{num(4)}", lambda: f"+{rng.randint(1, 99)} {num(3)} {num(3)} {num(3)}", lambda: f"00{rng.randint(30, 99)} {num(2)} {num(7)}",
    ]
    email = [lambda: f"{word()}.{rng.randint(1, 99)}@{word()}.example.com", lambda: f"{word()}_{word()}@{word()}.org", lambda: f"{word()}@{word()}", lambda: f"{word()}{num(2)}@localhost"]
    ip = [lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), lambda: str(ipaddress.IPv6Address(0x20010DB8 << 96 | rng.getrandbits(rng.choice([16, 64, 96]))))]
    cards = [lambda: card(True), lambda: four(card(True), " "), lambda: four(card(True), "-"), lambda: four(card(True), ".")]
    clean = [
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", lambda: f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/{rng.randint(1990, 2030)}", lambda: f"{rng.randint(0, 23):02}:{rng.randint(0, 59):02}", lambda: str(rng.randint(1, 99999)), lambda: f"#{num(8)}",
        lambda: f"{rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}", lambda: f"${rng.randint(1, 999)},{num(3)}.{num(2)}", lambda: card(False), lambda: four(card(False), " "), lambda: f"978-{num(1)}-{num(2)}-{num(6)}-{num(1)}", lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)),
        lambda: f"https://{word()}.example/{num(3)}", lambda: f"@{word()}", lambda: f"{num(3)}%", lambda: f"{num(2)}x{num(2)}", lambda: f"{word()}{num(2)}", lambda: num(10), lambda: f"{num(3)}-{num(3)}", lambda: f"{num(4)}-{num(4)}", lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: f"{num(3)} {num(3)}", lambda: f"{num(5)} {num(4)}",
    ]
    hints = {"phone": ["call", "phone:", "tel", "fax", "tel."], "email": ["mail", "email:", "contact"], "ip": ["host", "ip", "from", "server"], "card": ["card", "visa", "number"], "O": ["on", "order", "no.", "page", "version", "isbn", "price", "at"]}
    makers = {"phone": phone, "email": email, "ip": ip, "card": cards, "O": clean}
    out = []
    for _ in range(rows):
        tokens, labels = [], []
        for _ in range(rng.randint(1, 3)):
            filler = [word() for _ in range(rng.randint(1, 6))]
            kind = rng.choice(["O", "O", *KINDS, "phone"])
            if rng.random() < 0.4:
                filler.append(rng.choice(hints[kind]))
            tokens += filler
            labels += ["O"] * len(filler)
            own = rng.choice(makers[kind])().split(" ")
            if rng.random() < 0.2:
                own[-1] += rng.choice(".,;)")
            tokens += own
            labels += ["O"] * len(own) if kind == "O" else [f"B-{kind}", *[f"I-{kind}"] * (len(own) - 1)]
        if rng.random() < 0.8:
            tokens.append(word())
            labels.append("O")
        out.append((tokens, labels))
    return out


def runs_of(tokens: list[str]) -> list[tuple[int, int]]:
    """Runs of tokens with a digit or @."""
    out: list[tuple[int, int]] = []
    for k, t in enumerate(tokens):
        if TRIGGER.search(t):
            if out and out[-1][1] == k:
                out[-1] = (out[-1][0], k + 1)
            else:
                out.append((k, k + 1))
    return out


class Field:
    """A linear-chain field: weights of (feature, label), (label, label), and of O before and after a run."""

    def __init__(self, known: dict[str, int], emit: np.ndarray, trans: np.ndarray):
        self.known, self.emit, self.trans = known, emit, trans

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), len(LABELS)))
        for k, names in enumerate(rows):
            own = [i for n in names if (i := self.known.get(n)) is not None]
            out[k] = self.emit[own].sum(axis=0)
        return out

    def decode(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of runs of scores; those of one length are decoded together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(runs)
        by: dict[int, list[int]] = defaultdict(list)
        for k, r in enumerate(runs):
            by[len(r)].append(k)
        for n, own in by.items():
            for at in range(0, len(own), 4096):
                part = own[at : at + 4096]
                e = np.stack([runs[k] for k in part])
                best, back = e[:, 0] + self.trans[0], []
                for t in range(1, n):
                    step = best[:, :, None] + self.trans[None]
                    back.append(step.argmax(axis=1))
                    best = step.max(axis=1) + e[:, t]
                label = (best + self.trans[:, 0]).argmax(axis=1)
                path = [label]
                for b in reversed(back):
                    label = b[np.arange(len(part)), label]
                    path.append(label)
                for k, p in zip(part, np.stack(path[::-1], axis=1), strict=True):
                    out[k] = p
        return out


def forbidden() -> np.ndarray:
    """Label pairs that can't be: an I behind anything but its own B or I."""
    n = len(LABELS)
    bad = np.zeros((n, n), bool)
    for b, name in enumerate(LABELS):
        if name[0] == "I":
            bad[:, b] = [a[2:] != name[2:] for a in LABELS]
    return bad


def train(table: list[tuple[list[str], list[str]]], steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Field:
    """Maximum likelihood by Adam over all runs of the table at once (forward-backward in numpy)."""
    names: dict[str, int] = {}
    runs = []
    for tokens, labels in table:
        for a, b in runs_of(tokens):
            rows = [[names.setdefault(f, len(names)) for f in features(tokens, k)] for k in range(a, b)]
            runs.append((rows, [LABELS.index(x) for x in labels[a:b]]))
    n, wide, long = len(LABELS), max(len(r) for rows, _ in runs for r in rows), max(len(r) for r, _ in runs)
    index = np.full((len(runs), long, wide), len(names))
    gold = np.zeros((len(runs), long), np.int64)
    real = np.zeros((len(runs), long), bool)
    for i, (rows, labels) in enumerate(runs):
        for t, own in enumerate(rows):
            index[i, t, : len(own)] = own
        gold[i, : len(labels)] = labels
        real[i, : len(labels)] = True
    bad = forbidden()
    emit, trans = np.zeros((len(names) + 1, n)), np.zeros((n, n))
    moments = [np.zeros_like(emit), np.zeros_like(trans), np.zeros_like(emit), np.zeros_like(trans)]
    eye = np.eye(n)
    # a run goes from O to O: padding is O, at no cost, and gold is O there
    top = lambda a, axis: (m := a.max(axis=axis, keepdims=True)) + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))
    pad = np.where(eye[0] > 0, 0.0, -1e9)
    flat = index[real]
    for step in range(1, steps + 1):
        move = np.where(bad, -1e9, trans)
        e = np.where(real[..., None], emit[index].sum(axis=2), pad)
        forward = np.empty_like(e)
        forward[:, 0] = move[0] + e[:, 0]
        steps_on = [np.where(real[:, t, None, None] | real[:, t - 1, None, None], move[None], np.where(eye > 0, 0.0, -1e9)[None]) for t in range(1, long)]
        for t in range(1, long):
            forward[:, t] = top(forward[:, t - 1][:, :, None] + steps_on[t - 1], 1)[:, 0] + e[:, t]
        last = np.where(real[:, -1, None], move[:, 0][None], 0.0)
        back = np.empty_like(e)
        back[:, -1] = last
        for t in range(long - 2, -1, -1):
            back[:, t] = top(steps_on[t] + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)[:, :, 0]
        total = top(forward[:, -1] + last, 1)[:, 0]
        marginal = np.exp(forward + back - total[:, None, None])
        g_emit, g_trans = np.zeros_like(emit), np.zeros_like(trans)
        diff = (eye[gold] - marginal)[real]
        for k in range(wide):
            np.add.at(g_emit, flat[:, k], diff)
        g_trans[0] += (eye[gold[:, 0]] - marginal[:, 0]).sum(axis=0)
        for t in range(1, long):
            on = real[:, t] | real[:, t - 1]
            both = np.exp(forward[:, t - 1][:, :, None] + steps_on[t - 1] + (e[:, t] + back[:, t])[:, None, :] - total[:, None, None])
            np.add.at(g_trans, (gold[on, t - 1], gold[on, t]), 1.0)
            g_trans -= both[on].sum(axis=0)
        full = real[:, -1]
        if full.any():
            np.add.at(g_trans, (gold[full, -1], 0), 1.0)
            g_trans[:, 0] -= marginal[full, -1].sum(axis=0)
        g_emit[-1] = 0
        for w, g, m, v in ((emit, g_emit, moments[0], moments[2]), (trans, g_trans, moments[1], moments[3])):
            g = g / len(runs) - penalty * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(names, emit[:-1], np.where(bad, -1e9, trans))


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_rows())


def plausible(kind: int, s: str) -> bool:
    """Whether a span of the field can be what it is said to be."""
    d = digits_of(s)
    if kind == 0:
        return s.count("@") == 1 and all(s.split("@"))
    if kind == 1:
        return is_ip(s)
    return 12 <= len(d) <= 19 and luhn(d) if kind == 2 else 7 <= len(d) <= 15


def all_spans(texts: list[str], field: Field) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, of the patterns) by start and kind, of each text."""
    base = [base_spans(t) for t in texts]
    runs: list[np.ndarray] = []
    places: list[tuple[int, list[tuple[int, int]]]] = []
    for i, text in enumerate(texts):
        if not TRIGGER.search(text):
            continue
        at = 0
        for line in text.split("\n"):
            if TRIGGER.search(line):
                found = list(TOKEN.finditer(line))
                tokens = [m[0] for m in found]
                for a, b in runs_of(tokens):
                    runs.append(field.scores([features(tokens, k) for k in range(a, b)]))
                    places.append((i, [(at + m.start(), at + m.end()) for m in found[a:b]]))
            at += len(line) + 1
    extra: dict[int, list[Span]] = defaultdict(list)
    for (i, where), labels in zip(places, field.decode(runs), strict=True):
        t = 0
        while t < len(where):
            name = LABELS[labels[t]]
            if name[0] != "B":
                t += 1
                continue
            stop = t + 1
            while stop < len(where) and LABELS[labels[stop]] == f"I-{name[2:]}":
                stop += 1
            start, end = where[t][0], where[stop - 1][1]
            text, kind = texts[i], KINDS.index(name[2:])
            while end > start and text[end - 1] in ".,;:!?)]}>\"'" and not (text[end - 1] == ":" and text[end - 2 : end] == "::"):
                end -= 1
            while start < end and text[start] in "[{<\"'" or start < end and text[start] == "(" and text.find(")", start, end) < 0:
                start += 1
            if plausible(kind, text[start:end]):
                extra[i].append((kind, start, end))
            t = stop
    out = []
    for i, own in enumerate(base):
        more = []
        if i in extra:  # one walk along both, by start: how far the patterns' spans that begin before a span reach
            starts = sorted((s, e) for _, s, e in own)
            k = reach = 0
            for x in sorted(extra[i], key=lambda x: x[1]):
                while k < len(starts) and starts[k][0] <= x[1]:
                    reach = max(reach, starts[k][1])
                    k += 1
                if reach <= x[1] and (k == len(starts) or starts[k][0] >= x[2]):
                    more.append(x)
        out.append(sorted([(*s, True) for s in own] + [(*s, False) for s in more], key=lambda s: (s[1], s[0])))
    return out


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_spans(text: Column, field: Field | None = None) -> Column:
    """SPANS of a text column, by start and kind. base: found by the patterns."""
    model = field or default_field()

    @F.arrow_udf(SPANS)
    def of(texts: pa.Array) -> pa.Array:
        rows = all_spans([t or "" for t in texts.to_pylist()], model)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        return pa.array([[{"kind": KINDS[k], "start": a, "end": b, "base": p} for k, a, b, p in r] for r in rows], pa.list_(kind))

    return of(whole_text(text))


def without(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span (kind, start, end) replaced by its kind in brackets."""
    if not spans:
        return text
    parts, at, end = [], 0, -1
    for kind, start, stop in spans:
        if start >= end:
            parts += [text[max(at, 0) : start], f"[{kind.upper()}]"]
        at = end = max(end, stop)
    return "".join(parts) + text[at:]


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that meet are one, of the first's kind."""

    @F.arrow_udf("string")
    def of(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([without(t, [(s["kind"], s["start"], s["end"]) for s in own or ()]) for t, own in zip(texts.to_pylist(), found.to_pylist(), strict=True)], pa.string())

    return of(F.make_valid_utf8(text), spans)


def redacted(text: Column, field: Field | None = None) -> Column:
    """``redact`` with the spans of ``find_spans``, in one Python worker for a task instead of two: an executor keeps
    as many workers as its tasks ever had at once, and each its memory."""
    model = field or default_field()

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        found = all_spans([t or "" for t in rows], model)
        return pa.array([without(t, [(KINDS[k], a, b) for k, a, b, _ in own]) for t, own in zip(rows, found, strict=True)], pa.string())

    return of(F.make_valid_utf8(text.cast("string")))
