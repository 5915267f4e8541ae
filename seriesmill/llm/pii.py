"""Personal data by a semi-Markov conditional random field over candidate segments.

Base spans are those of four fixed patterns and checks. The field adds spans of the same kinds in other spellings (an e-mail
address with words for its signs, a card or phone number in other groupings). A text is cut into regions around digits, signs
and words that an entity needs; everything else is outside for certain. In a region a candidate is a run of at most ``MOST_TOKENS`` tokens that
may be an entity of a kind; its features see the whole span (check digits, groups, separators, form of the signs,
what stands around it, whether it could go on). The score of a segmentation is the sum of its segments' weights and
of the transitions between neighbours, everything outside scoring 0. Bounded-entity dynamic programming over the ends of candidates gives
the partition sum for fitting and the best segmentation for finding, so boundaries and kinds are chosen together.

Fitting needs no annotation: base spans of a bounded sample of regions (``PER_CLASS`` regions for each kind and for none, from
about ``SAMPLE_DOCS`` documents chosen by hash) are the truth, beside copies of those regions in which the spans are respelt,
and copies with numbers that are no personal data. Weights are fitted in one task on that sample. Finding is one pass over all texts.

Base spans stay, and added ones never touch them. A null text is empty; empty texts have no spans; repeated rows get equal
rows; a null ``doc_id`` is kept; extra columns are ignored; without a sample nothing is added; an empty table gives no rows. Texts are
taken whole: patterns and regions are found in time linear in the text. Positions are code points.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.session import stage

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 20_000
PER_CLASS = 600
MOST_TOKENS = 24
#: Characters on each side of a sign or number that belong to its region; an entity has at most so many in a part.
REACH = 64
LONGEST_SAMPLE = 1_000
ROUNDS, STEP, PENALTY = 60, 0.3, 0.002

# Fixed patterns of the base spans. A run of digits is entered at its begin only, which finds the same matches in linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NEEDED = re.compile(r"[0-9]+|@|[\[({<]\s?(?:at|dot)\s?[\])}>]| dot ", re.I)
TOKEN = re.compile(
    r"(?P<at>\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?|\s?@\s?| at )|(?P<dot>\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?| dot |\.)"
    r"|(?P<num>[0-9]+)|(?P<word>[^\W\d_]+)|(?P<other>.)",
    re.I | re.S,
)
#: What may stand between the digits of a number.
BETWEEN = frozenset(" .-()/_+\u00a0\u2013\u2011\u00b7")


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in re.findall("[0-9]+", text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, sign) if start < sign else None
        if found:
            free = found.end()
            yield start, free
        sign = text.find("@", max(sign + 1, free))


def digits_of(text: str) -> str:
    return re.sub("[^0-9]+", "", text)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if small_parts(m.group())]
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return out


def regions(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) around what an entity needs."""
    begin = end = None
    for m in NEEDED.finditer(text):
        low, high = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if end is not None and low <= end:
            end = max(end, high)
            continue
        if end is not None:
            yield begin, end
        begin, end = low, high
    if end is not None:
        yield begin, end


class Token(NamedTuple):
    kind: str
    start: int
    end: int


class Segment(NamedTuple):
    kind: str
    start: int
    end: int
    features: tuple[str, ...]


def _edge(char: str) -> str:
    return "end" if not char else "space" if char.isspace() else "alnum" if char.isalnum() else char


def _around(text: str, start: int, end: int) -> list[str]:
    """What stands next to a span, and whether a number would go on there."""
    before, after = text[:start][-1:], text[end : end + 1]
    left, right = re.search(r"[0-9][^\w\n]?$", text[max(0, start - 2) : start]), re.match(r"[^\w\n]?[0-9]", text[end : end + 2])
    return [f"before {_edge(before)}", f"after {_edge(after)}", f"goes on {bool(left)} {bool(right)}"]


def _number_segments(text: str, tokens: list[Token]) -> Iterator[Segment]:
    for i, first in enumerate(tokens):
        opens = text[first.start : first.end] in ("+", "(") and i + 1 < len(tokens) and (tokens[i + 1].kind == "num" or text[first.start] == "+")
        if not (opens or first.kind == "num") or text[max(0, first.start - 1) : first.start].isalnum():
            continue
        groups, marks, gap = [], [], ""
        for token in tokens[i : i + MOST_TOKENS]:
            piece = text[token.start : token.end]
            if token.kind != "num":
                gap += piece
                if len(piece) == 1 and piece not in BETWEEN or token.kind in ("word", "at") or "\n" in piece or len(gap) > 8:
                    break
                continue
            marks.append(gap)
            groups.append(piece)
            gap = ""
            count = sum(map(len, groups))
            if count > 19:
                break
            if count < 4 or text[token.end : token.end + 1].isalnum():
                continue
            around, inner = _around(text, first.start, token.end), marks[1:]
            if len(groups) == 4 and all(inner) and small_parts(" ".join(groups)) and not marks[0]:
                form = inner[0].lower().strip() if len({m.lower().strip() for m in inner}) == 1 else "mixed"
                yield Segment("ip", first.start, token.end, ("ip", f"ip marks {form}", *(f"ip {a}" for a in around)))
            shape = "-".join(str(len(g)) for g in groups)
            kinds = "".join(sorted(set("".join(inner)))) or "none"
            if 13 <= count <= 19 and not marks[0]:
                check = f"card check {luhn(''.join(groups))}"
                yield Segment("card", first.start, token.end, ("card", check, f"{check} {shape}", f"card marks {kinds}", f"card digits {count}", *(f"card {a}" for a in around)))
            if 9 <= count <= 15:
                opening = marks[0] or ("00" if groups[0].startswith("00") else "digit")
                own = (f"phone from {opening}", f"phone shape {shape}", f"phone tail {'-'.join(str(len(g)) for g in groups[-3:])}", f"phone marks {kinds}")
                yield Segment("phone", first.start, token.end, ("phone", *own, f"phone digits {count}", f"phone groups {min(len(groups), 6)}", *(f"phone {a}" for a in around)))


def _address_segments(text: str, tokens: list[Token]) -> Iterator[Segment]:
    def named(token: Token) -> bool:
        return token.kind in ("word", "num") or token.kind == "other" and text[token.start] in LOCAL

    for a, sign in enumerate(tokens):
        if sign.kind != "at":
            continue
        plain = text[sign.start : sign.end] == "@"
        spelt = text[sign.start : sign.end].lower() == " at "
        starts, i = [], a - 1
        while i >= 0 and a - i < MOST_TOKENS // 2 and (named(tokens[i]) or tokens[i].kind == "dot"):
            if tokens[i].kind in ("word", "num") and not (i and named(tokens[i - 1]) and tokens[i - 1].end == tokens[i].start):
                starts.append(i)
            i -= 1
        ends, dots, j = [], [], a + 1
        while j < len(tokens) and j - a < MOST_TOKENS // 2 and (named(tokens[j]) or tokens[j].kind == "dot"):
            if tokens[j].kind == "dot":
                if j == a + 1 or tokens[j - 1].kind == "dot":
                    break
                dots.append(text[tokens[j].start : tokens[j].end].lower())
            elif dots and tokens[j].kind == "word" and not (j + 1 < len(tokens) and named(tokens[j + 1])):
                ends.append((j, list(dots)))
            j += 1
        for i in starts:
            for j, dots in ends:
                if spelt and "." in dots:  # a sentence, not an address
                    continue
                start, end = tokens[i].start, tokens[j].end
                form = dots[0].strip() if len(set(dots)) == 1 else "mixed"
                more = j + 1 < len(tokens) and tokens[j + 1].kind == "dot" and j + 2 < len(tokens) and tokens[j + 2].kind == "word"
                less = i > 0 and tokens[i - 1].kind == "dot" and i > 1 and named(tokens[i - 2])
                own = (f"email sign {text[sign.start : sign.end].lower().strip()} {plain}", f"email dots {form}", f"email goes on {less} {more}")
                top = f"email top {min(tokens[j].end - tokens[j].start, 5)}"
                yield Segment("email", start, end, ("email", *own, top, f"email labels {min(len(dots), 4)}", *(f"email {x}" for x in _around(text, start, end)[:2])))


def candidates(text: str) -> list[Segment]:
    """Segments of a region that may be entities, by start and end. Tokens that the region cuts are none of theirs."""
    tokens = [Token(m.lastgroup, *m.span()) for m in TOKEN.finditer(text)]
    found = [*_number_segments(text, tokens), *_address_segments(text, tokens)]
    return sorted(found, key=lambda s: (s.start, s.end, s.kind))


def _score(weights: dict[str, float], names) -> float:
    return sum(weights.get(n, 0.0) for n in names)


def _next_to(before: str | None, kind: str) -> str:
    return f"next to {before} {kind}"


def best_segments(segments: list[Segment], weights: dict[str, float]) -> list[Segment]:
    """The segmentation of the highest score; of equal ones the one with fewer segments."""
    places = sorted({p for s in segments for p in (s.start, s.end)})
    if not places:
        return []
    # best[place][kind of the segment that ends there, or None]: (score, segments, (segment, kind before it))
    best: dict[int, dict] = {p: {} for p in places}
    best[places[0]][None] = (0.0, 0, None)
    starting: dict[int, list[Segment]] = {}
    for s in segments:
        starting.setdefault(s.start, []).append(s)

    def offer(place, kind, value):
        known = best[place].get(kind)
        if known is None or (value[0], -value[1]) > (known[0], -known[1]):
            best[place][kind] = value

    for at, place in enumerate(places):
        for kind, (score, size, _) in list(best[place].items()):
            if at + 1 < len(places):
                offer(places[at + 1], None, (score, size, (place, kind, None)))
            for s in starting.get(place, ()):
                gain = _score(weights, s.features) + (weights.get(_next_to(kind, s.kind), 0.0) if kind else 0.0)
                offer(s.end, s.kind, (score + gain, size + 1, (place, kind, s)))
    kind = max(best[places[-1]], key=lambda k: (best[places[-1]][k][0], -best[places[-1]][k][1]))
    out, step = [], best[places[-1]][kind][2]
    while step:
        place, kind, segment = step
        if segment:
            out.append(segment)
        step = best[place][kind][2]
    return out[::-1]


class Region(NamedTuple):
    """A region for fitting: candidates with numbered features, and which of them are true."""

    segments: list[Segment]
    features: list[np.ndarray]
    truth: list[int]


LABELS = (None, *KINDS)


def log_likelihood(region: Region, weights: np.ndarray, number: dict[str, int]) -> tuple[float, np.ndarray]:
    """log P(truth) and its gradient, by sums over all segmentations forwards and backwards."""
    segments = region.segments
    scores = [float(weights[f].sum()) for f in region.features]
    places = sorted({p for s in segments for p in (s.start, s.end)})
    rank = {p: i for i, p in enumerate(places)}
    near = {(y, z): number[_next_to(y, z)] for y in KINDS for z in KINDS}
    size = len(places)
    forward = [dict.fromkeys(LABELS, -np.inf) for _ in places]
    backward = [dict.fromkeys(LABELS, -np.inf) for _ in places]
    forward[0][None] = 0.0
    starting = [[] for _ in places]
    for k, s in enumerate(segments):
        starting[rank[s.start]].append(k)
    add = np.logaddexp
    for i in range(size):
        for label, score in forward[i].items():
            if score == -np.inf:
                continue
            if i + 1 < size:
                forward[i + 1][None] = add(forward[i + 1][None], score)
            for k in starting[i]:
                s = segments[k]
                gain = scores[k] + (weights[near[label, s.kind]] if label else 0.0)
                to = forward[rank[s.end]]
                to[s.kind] = add(to[s.kind], score + gain)
    total = np.logaddexp.reduce(list(forward[-1].values()))
    backward[-1] = dict.fromkeys(LABELS, 0.0)
    gradient = np.zeros(len(weights))
    for i in range(size - 1, -1, -1):
        for label in LABELS:
            out = backward[i][label] if i == size - 1 else backward[i + 1][None]
            for k in starting[i]:
                s = segments[k]
                gain = scores[k] + (weights[near[label, s.kind]] if label else 0.0)
                onward = gain + backward[rank[s.end]][s.kind]
                out = add(out, onward)
                if forward[i][label] > -np.inf:
                    chance = np.exp(forward[i][label] + onward - total)
                    gradient[region.features[k]] -= chance
                    if label:
                        gradient[near[label, s.kind]] -= chance
            backward[i][label] = out
    value, before = -total, None
    for k in region.truth:
        value += scores[k]
        gradient[region.features[k]] += 1
        if before is not None and segments[before].end == segments[k].start:
            pair = near[segments[before].kind, segments[k].kind]
            value += weights[pair]
            gradient[pair] += 1
        before = k
    return value, gradient


# --- Respelling: fixed forms in which the same data are written, and of numbers that are no personal data.
SIGNS = ((" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" @ ", "."), ("(at)", "."))
IP_MARKS = ("[.]", " . ", "(.)", " dot ", "[dot]")
CARD_MARKS = (".", "/", "\u00a0", "_", "  ", "\u2013", " - ")
PHONE_FORMS = ("{0} ({1}) {2}-{3}", "({1}) {2}-{3}", "{1}-{2}-{3}", "{1}.{2}.{3}", "{1} {2} {3}", "00{0} {1} {2} {3}", "+{0}/{1}/{2}-{3}", "{0}-{1}-{2}-{3}")
OTHER_NUMBERS = ("20{0}-01-1{1}  20{2}-02-0{3}", "1{0}.05.2023-14.06.20{1}", "{0}{0} 000 {1}{0}0 000", "3.14{0}{1} 2.71{2}8{3}", "1{0}:{1}0 20{2}{3}-12-24", "(2{0}{1}) 1{2}3-20{3}{0}4 0{1}", "{0}{1}{2}{3}{0}{1}{2}{3}{0}", "1 2 3 4 5 6 7 8 9 1{0}", "20{0}{1}-20{2}{3} 1{0}0{1}")


def respelt(kind: str, text: str, turn: int) -> str:
    digits = digits_of(text)
    if kind == "email":
        sign, dot = SIGNS[turn % len(SIGNS)]
        local, domain = text.split("@", 1)
        return local + sign + domain.replace(".", dot)
    if kind == "ip":
        return text.replace(".", IP_MARKS[turn % len(IP_MARKS)])
    if kind == "card":
        return CARD_MARKS[turn % len(CARD_MARKS)].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    parts = digits[:-10] or "1", digits[-10:-7], digits[-7:-4], digits[-4:]
    return PHONE_FORMS[turn % len(PHONE_FORMS)].format(*parts) if all(parts) else text


def copies(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """The region itself, a copy with its entities respelt, one with other numbers, and one with its long numbers regrouped."""
    yield text, spans
    turn = zlib.crc32(text.encode())

    def with_parts(parts):
        out, found, end = "", [], 0
        for kind, a, b, part in parts:
            out += text[end:a]
            if kind:
                found.append((kind, len(out), len(out) + len(part)))
            out, end = out + part, b
        return out + text[end:], found

    if spans:
        yield with_parts([(kind, a, b, respelt(kind, text[a:b], turn + i)) for i, (kind, a, b) in enumerate(spans)])
        fill = [int(c) for c in f"{turn % 10000:04d}"]
        other = OTHER_NUMBERS[turn // 7 % len(OTHER_NUMBERS)].format(*fill)
        yield with_parts([(None if i == 0 else kind, a, b, other if i == 0 else text[a:b]) for i, (kind, a, b) in enumerate(spans)])
    long = [m for m in re.finditer(r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])", text) if not any(a < m.end() and m.start() < b for _, a, b in spans)]
    if long:
        parts = [(kind, a, b, text[a:b]) for kind, a, b in spans] + [(None, *m.span(), respelt("card", m.group(), turn)) for m in long]
        yield with_parts(sorted(parts, key=lambda p: p[1]))


def fitting_region(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[Segment], list[int]] | None:
    """Candidates and the true ones; None if there are no candidates or a true span is none of them."""
    found = candidates(text)
    place = {s[:3]: k for k, s in enumerate(found)}
    if not found or any(s not in place for s in spans):
        return None
    return found, sorted(place[s] for s in spans)


def fit(rows: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = ROUNDS) -> dict[str, float]:
    """Weights of the features by gradient ascent on the penalised likelihood of regions (text, true spans)."""
    made = [r for text, spans in rows for r in (fitting_region(*c) for c in copies(text, spans)) if r]
    names = sorted({n for found, _ in made for s in found for n in s.features} | {_next_to(y, z) for y in KINDS for z in KINDS})
    number = {n: i for i, n in enumerate(names)}
    data = [Region(found, [np.array([number[n] for n in s.features]) for s in found], truth) for found, truth in made]
    weights, squares = np.zeros(len(names)), np.full(len(names), 1e-8)
    for _ in range(rounds if data else 0):
        gradient = sum(log_likelihood(r, weights, number)[1] for r in data) / len(data) - PENALTY * weights
        squares += gradient**2
        weights += STEP * gradient / np.sqrt(squares)
    return dict(zip(names, weights.tolist()))


def without_overlap(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    out, end = [], 0
    for span in sorted(spans, key=lambda s: (s[1], -s[2])):
        if span[1] >= end:
            out.append(span)
            end = span[2]
    return out


def _sample(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, text, spans) of the regions with candidates; class is the kind of the first base span."""
    for batch in source:
        out = {"class": [], "region": [], "spans": []}
        for text in batch.column("text").to_pylist():
            base = without_overlap(base_spans(text or ""))
            for a, b in regions(text or ""):
                inside = [(kind, x - a, y - a) for kind, x, y in base if a <= x and y <= b]
                if b - a > LONGEST_SAMPLE or fitting_region(text[a:b], inside) is None:
                    continue
                out["class"].append(inside[0][0] if inside else "none")
                out["region"].append(text[a:b])
                out["spans"].append(",".join(f"{kind}:{x}:{y}" for kind, x, y in inside))
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in out.values()], list(out))


def _fit(key, table):
    rows = []
    for text, spans in sorted(zip(table.column("region").to_pylist(), table.column("spans").to_pylist())):
        rows.append((text, [(k, int(x), int(y)) for k, x, y in (s.split(":") for s in spans.split(",") if s)]))
    weights = fit(rows)
    return pa.table({"feature": pa.array(list(weights), pa.string()), "weight": pa.array(list(weights.values()), pa.float64())})


def fitted(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, per_class: int = PER_CLASS) -> dict[str, float]:
    """Weights fitted on base spans of a bounded sample of regions."""
    rows = docs.count()
    few = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample_docs / max(1, rows)))
    found = docs.filter(few).select("text").mapInArrow(_sample, "class string, region string, spans string").distinct()
    place = F.row_number().over(Window.partitionBy("class").orderBy(F.xxhash64("region"), "region"))
    sample = found.withColumn("place", place).filter(F.col("place") <= per_class).withColumn("all", F.lit(1))
    weights = stage(sample.groupBy("all").applyInArrow(_fit, "feature string, weight double"), "weights")
    return {r["feature"]: r["weight"] for r in weights.collect()}  # features of at most 5 * per_class regions


def all_spans(text: str, weights: dict[str, float]) -> tuple[list, list]:
    """(base spans, added spans) of a text."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    begins, added = np.array([a for a, _ in taken]), []
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else begins
    for low, high in regions(text):
        free = []
        for s in candidates(text[low:high]):
            a, b = s.start + low, s.end + low
            cut = a == low and a > 0 and text[a - 1].isalnum() or b == high and text[b : b + 1].isalnum()
            # No base span begins before b and ends after a.
            at = int(np.searchsorted(begins, b)) if taken else 0
            if not cut and not (at and ends[at - 1] > a):
                free.append(s)
        added += [(s.kind, s.start + low, s.end + low) for s in best_segments(free, weights)]
    return base, added


def joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in ordered)


def _found(weights):
    schema = {"doc_id": None, **{f"n_{k}": pa.int64() for k in KINDS}, "base_sha256": pa.string(), "spans": pa.string(), "n_added": pa.int64()}

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = {name: [] for name in schema if name != "doc_id"}
            for text in batch.column("text"):
                base, added = all_spans(text.as_py() or "", weights.value)
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(base + added))
                out["n_added"].append(len(added))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(v, schema[n]) for n, v in out.items()]], list(schema))

    return run


def personal_data(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row.

    The counts and the digest are those of the base spans; ``spans`` has all, as kind:start:end.
    """
    source = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(fitted(source) if weights is None else weights)
    kind = source.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return source.mapInArrow(_found(shared), f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")
