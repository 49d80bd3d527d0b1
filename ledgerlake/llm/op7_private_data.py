"""Personal data: rules, and a tagger that adds what the rules miss.

The rules find e-mail addresses, IP addresses, card and phone numbers in their plain forms, and
their spans always stay. A character-level bidirectional LSTM with CRF transitions (see
``tagger``) is trained from spans that the rules label in a bounded sample of contexts, in their
plain form and rewritten as people disguise them: "name (at) host.tld", "1[.]2[.]3[.]4", other
separators, phone numbers without "+". It reads every place with a digit, an "@" or a written
"(at)", without one of which no such span exists; overlapping windows are scored one by one and
decoded by one path for the whole passage. A span that it finds is added if it overlaps no other
one and, written plainly, meets the rule of its kind (digits, check sum, ranges).

Null and empty texts have no spans. Texts of any length are read whole; each row is treated on
its own. Spans do not overlap within a kind and are ordered by kind and place. Without labelled
contexts, as in an empty table, the rules stand alone. Existing columns with the names of new
ones are replaced.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.base import prepare, table, texts_of, with_fields
from ledgerlake.llm.tagger import KINDS, STRIDE, WINDOW, Tagger, ids_of

#: Contexts per kind, and without a span, that the tagger is trained on; training steps.
PER_KIND, STEPS = 400, 260
AROUND = 40
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_TRIGGER = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]", re.I)
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"\s*[(\[{]\s*(?:@|at)\s*[)\]}]\s*|\s*@\s*", re.I)
_DOT = re.compile(r"\s*[(\[{]\s*(?:\.|dot)\s*[)\]}]\s*", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of the address pattern. An address begins where the run of characters
    before its "@" does, so that long runs are walked once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _fits(number: str) -> bool:
    return len(number.lstrip("0")) <= 3 and int(number.lstrip("0") or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the rules, by kind, then place."""
    if not _ANY.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_fits, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def plausible(kind: int, span: str) -> bool:
    """Whether a span, written plainly, meets the rule of its kind."""
    if kind == 0:
        plain = _DOT.sub(".", _AT.sub("@", span))
        return len(plain) <= 254 and list(_emails(plain)) == [(0, len(plain))]
    if kind == 1:
        plain = _DOT.sub(".", span).replace(" ", "")
        m = _IP.fullmatch(plain)
        return bool(m) and all(map(_fits, plain.split(".")))
    digits = "".join(_DIGIT.findall(span))
    if kind == 2:
        return bool(re.fullmatch(r"[0-9 ._/-]+", span)) and 13 <= len(digits) <= 19 and luhn(digits)
    return bool(re.fullmatch(r"(\+|\(|0)[0-9 ()./-]+[0-9]", span)) and 9 <= len(digits) <= 15


def disguised(kind: int, span: str, rng: random.Random) -> str:
    """The span as people write it to escape the rules."""
    if kind == 0:
        name, host = span.split("@", 1)
        at = rng.choice([" (at) ", " [at] ", "[@]", " @ ", "(at)", "[at]"])
        return name + at + (host.replace(".", rng.choice(["[.]", "(dot)", " [dot] "])) if rng.random() < 0.4 else host)
    if kind == 1:
        return span.replace(".", rng.choice(["[.]", "(.)", " . "]))
    digits = "".join(_DIGIT.findall(span))
    if kind == 2:
        cut = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return rng.choice([".", "/", "_", "  "]).join(cut)
    form = rng.randrange(3)
    if form == 0:
        return "00" + digits
    if form == 1:
        return f"({digits[:3]}) {digits[3:6]}-{digits[6:]}"
    return "0" + digits[:3] + "/" + digits[3:]


def _contexts(docs: DataFrame, text: str) -> DataFrame:
    """Passages around labelled spans, and around digits that are none."""

    def emit(batches):
        for batch in batches:
            kinds, passages = [], []
            for t in texts_of(batch.column(0)):
                spans, end = base_spans(t), -1
                if spans or _ANY.search(t):
                    for kind, a, b in spans:
                        if b - a < WINDOW - 10:
                            kinds.append(kind)
                            passages.append(t[max(0, a - AROUND):b + AROUND])
                    inside, at = sorted((a - 20, b + 20) for _, a, b in spans), 0
                    reach = -1  # the furthest end of the spans that begin before this place
                    for m in _ANY.finditer(t):
                        while at < len(inside) and inside[at][0] <= m.start():
                            reach, at = max(reach, inside[at][1]), at + 1
                        if m.start() > end and m.start() >= reach:
                            kinds.append(len(KINDS))
                            passages.append(t[max(0, m.start() - AROUND):m.start() + AROUND])
                            end = m.start() + AROUND
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(passages, pa.string())],
                                             names=["kind", "passage"])

    return docs.select(text).mapInArrow(emit, "kind int, passage string")


def examples(passages: list[str], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows of characters and their tags: each passage plain and, if it has spans, disguised."""
    rng = random.Random(seed)
    ids, tags = [], []
    for passage in passages:
        spans = sorted(base_spans(passage), key=lambda s: s[1])
        spans = [s for k, s in enumerate(spans) if k == 0 or s[1] >= spans[k - 1][2]]
        for rewrite in (False, True, True) if spans else (False,):
            parts, mark, at = [], [], 0
            for kind, a, b in spans:
                found = disguised(kind, passage[a:b], rng) if rewrite else passage[a:b]
                parts += [passage[at:a], found]
                mark += [0] * (a - at) + [1 + 2 * kind] + [2 + 2 * kind] * (len(found) - 1)
                at = b
            parts.append(passage[at:])
            mark += [0] * (len(passage) - at)
            whole = "".join(parts)
            shift = rng.randint(0, max(0, min(24, len(whole) - WINDOW)))
            row, tag = np.zeros(WINDOW, dtype=np.int64), np.zeros(WINDOW, dtype=np.int64)
            piece = ids_of(whole[shift:shift + WINDOW])
            row[:len(piece)] = piece
            tag[:len(piece)] = mark[shift:shift + WINDOW]
            if tag[0] and tag[0] % 2 == 0:  # the window begins inside a span
                tag[0] -= 1
            ids.append(row)
            tags.append(tag)
    return np.array(ids), np.array(tags)


def train(docs: DataFrame, *, text: str = "text", per_kind: int = PER_KIND, steps: int = STEPS) -> Tagger | None:
    prepare(docs.sparkSession)
    order = Window.partitionBy("kind").orderBy(F.xxhash64("passage"), "passage")
    # Each passage once: a text with very many copies is one example.
    rows = (_contexts(docs, text).distinct().withColumn("nth", F.row_number().over(order))
            .where(F.col("nth") <= per_kind).orderBy("kind", "nth").collect())
    if not any(r["kind"] < len(KINDS) for r in rows):
        return None
    tagger = Tagger()
    tagger.fit(*examples([r["passage"] for r in rows]), steps=steps)
    return tagger


def find_spans(texts: list[str], tagger: Tagger | None) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, found by rule) of each text, by kind, then place."""
    out = [[(*s, True) for s in base_spans(t)] for t in texts]
    passages, place = [], []
    for k, t in enumerate(texts) if tagger is not None else ():
        start = end = None
        for m in _TRIGGER.finditer(t):
            if end is None or m.start() - AROUND > end:
                if end is not None:
                    passages.append(t[start:end])
                    place.append((k, start))
                start = max(0, m.start() - AROUND)
            end = min(len(t), m.end() + AROUND)
        if end is not None:
            passages.append(t[start:end])
            place.append((k, start))
    found = tagger.decode(passages) if passages else []
    touched = set()
    for (k, at), passage, spans in zip(place, passages, found):
        for kind, a, b in spans:
            while a < b and passage[a] in " ,;:":
                a += 1
            while a < b and passage[b - 1] in " ,;:.":
                b -= 1
            first, last = at + a, at + b
            if a < b and plausible(kind, passage[a:b]) \
                    and not any(s < last and first < e for _, s, e, _ in out[k]):
                out[k].append((kind, first, last, False))
                touched.add(k)
    for k in touched:
        out[k].sort()
    return out


def private_data(docs: DataFrame, tagger: Tagger | None, *, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start and end in characters, and whether a rule found it."""
    prepare(docs.sparkSession)
    docs = docs.drop("spans")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def find(batches):
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in found]
                     for found in find_spans(texts_of(batch.column(batch.schema.get_field_index(text))), tagger)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)],
                                             names=[*batch.schema.names, "spans"])

    return docs.mapInArrow(find, with_fields(docs, spans=SPANS))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = private_data(docs, train(docs))
    listed = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(listed.format("filter(spans, s -> s.base)")), 256).alias("base_sha256"),
        F.expr(listed.format("spans")).alias("spans"))
