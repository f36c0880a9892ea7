"""Personal data: base patterns, and further spans chosen by gradient-boosted trees.

High-recall generators propose overlapping spans of the four kinds in forms that the base
patterns miss (spelled-out addresses, other separators, national numbers). Boosted trees (Spark
ML) score each by features of its format and context. They learn from the table itself: positives are
the base spans and rewritten forms of them in their own context, negatives are proposals that can't
be valid (a wrong check digit, a part over 255) and damaged copies of base spans. Proposals that might be
valid have no label and are only scored. A held-out part, which the trees never see, sets
a threshold for each kind: the lowest score at which at most ``max_false`` of the held-out negatives
pass. Without enough held-out negatives a kind adds nothing.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import Scratch, text_key

KINDS = ("email", "ip", "card", "phone")
MAX_FALSE = 0.02
TRAIN_ROWS = 20_000
TREES, DEPTH = 15, 4

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match only ever begins where a run of digits begins, so looking behind changes nothing but speed
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_GENERATORS = (
    re.compile(
        r"(?<![\w.%+-])[\w.%+-]{1,64}\s?(?:\(at\)|\[at\]|\{at\}|@|\bat\b)\s?[\w-]{1,63}"
        # a plain dot stands between letters; one with a space after it ends a sentence
        r"(?:(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\bdot\b)\s?|\.)[\w-]{1,63}){1,4}",
        re.IGNORECASE,
    ),
    re.compile(r"(?<![0-9])[0-9]{1,4}(?:(?:\s?[.,_:-]\s?|\[\.\]|\(\.\)|\sdot\s)[0-9]{1,4}){3}(?![0-9])"),
    re.compile(r"(?<![0-9])[0-9](?:[\x20._/-]{0,3}[0-9]){12,18}(?![0-9])"),
    re.compile(r"(?<!\w)(?:\+|\()?[0-9][0-9\x20().\-/]{5,18}[0-9](?!\w)"),
)
_DIGIT = re.compile(r"[0-9]")
_SPELLED = re.compile(r"@|\bat\b", re.IGNORECASE)
_GROUP = re.compile(r"[0-9]+")
_ASCII_DIGITS = frozenset("0123456789")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        left = at
        while left > end and text[left - 1] in _LOCAL:
            left -= 1
        if left < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield left, end
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in code points, by kind and place; linear in the text."""
    out = [(0, *x) for x in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            # a part of many digits is compared by its length, as numbers of any size may stand there
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 40 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c in _ASCII_DIGITS for c in m[0]) <= 15:
                    out.append((3, *m.span()))
    return out


def _side(c: str) -> float:
    return 0.0 if not c or c.isspace() else 1.0 if c.isalpha() else 2.0 if c.isdigit() else 3.0


def features(kind: int, span: str, before: str, after: str) -> list[float]:
    """Format of ``span`` and its context, as numbers."""
    groups = _GROUP.findall(span)
    digits = "".join(groups)
    octets = [int(g) for g in groups[:5]] if all(len(g) <= 4 for g in groups[:5]) else []
    words = before.split()
    last = words[-1] if words else ""
    tail = re.split(r"[.\s)\]}]+", span.lower())[-1]
    return [
        float(kind),
        float(len(span)),
        float(len(digits)),
        float(sum(c.isalpha() for c in span)),
        float(span.count(" ")),
        float(span.count(".")),
        float(span.count("-")),
        float(span.count("(")),
        float(sum(c in ",_:/[]{}" for c in span)),
        float(span.startswith("+")),
        float("@" in span),
        float(bool(re.search(r"\(at\)|\[at\]|\{at\}", span.lower()))),
        float(bool(re.search(r"\bdot\b", span.lower()))),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(len(set(digits))),
        float(luhn(digits) if digits else 0),
        float(len(octets) == 4 and max(octets) <= 255),
        float(max(octets, default=0)),
        float(tail.isalpha()) * len(tail),
        _side(before[-1:]),
        _side(after[:1]),
        float(last[-1:] in (":", "=")) if last else 0.0,
        float(len(last)),
    ]


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) of everything that might be personal data; kinds overlap."""
    spelled, digit = _SPELLED.search(text), _DIGIT.search(text)
    for kind, pattern in enumerate(_GENERATORS):
        if spelled if kind == 0 else digit:
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end()


def plausible(kind: int, span: str) -> bool:
    """Whether the proposal, read without its separators, could be valid."""
    groups = _GROUP.findall(span)
    digits = "".join(groups)
    if kind == 0:
        return bool(re.search(r"[^\W\d_]{2,}$", span))
    if kind == 1:
        return len(groups) == 4 and all(int(g) <= 255 for g in groups)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def _rewritten(kind: int, span: str, rng: random.Random) -> str:
    """A form of a base span that people write too."""
    if kind == 0:
        name, _, host = span.partition("@")
        at, dot = rng.choice([("@", " dot "), (" (at) ", "."), ("[at]", "[dot]"), (" at ", " dot "), (" [at] ", " [dot] "), ("{at}", ".")])
        return f"{name}{at}{host.replace('.', dot)}"
    if kind == 1:
        return span.replace(".", rng.choice(["[.]", " . ", "(.)", " dot "]))
    digits = _digits(span)
    if kind == 2:
        return rng.choice([".", "_", "/", " - "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    short = digits[-10:] if len(digits) > 10 else digits
    a, b, c = short[:3], short[3:6], short[6:]
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits[: len(digits) - len(short)]} {a} {b} {c}", f"+{digits[:2]}/{a}/{b}{c}"])


def _damaged(kind: int, span: str, rng: random.Random) -> str:
    """Something of the same look that is no personal data of that kind."""
    if kind == 0:
        name, _, host = span.partition("@")
        return rng.choice([f"{name} at {host.split('.')[0]}. {host.split('.')[-1]}", f"{name.split('.')[0]}@{rng.randint(1, 9)}.{rng.randint(0, 99)}"])
    if kind == 1:
        parts = span.split(".")
        parts[rng.randrange(4)] = str(rng.randint(256, 9999))
        return rng.choice([".", ",", "-", ":"]).join(parts)
    digits = _digits(span)
    if kind == 2:
        i = rng.randrange(len(digits))
        wrong = digits[:i] + str((int(digits[i]) + rng.randint(1, 9)) % 10) + digits[i + 1 :]
        return rng.choice([wrong, "-".join(wrong[j : j + 4] for j in range(0, len(wrong), 4)), ".".join(wrong[j : j + 3] for j in range(0, len(wrong), 3))])
    return rng.choice([f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", f"{digits[:1]}.{digits[1:4]}.{digits[4:7]}", f"{digits[:4]}/{digits[4:8]}", digits[:7], digits[:9]])


_SPAN = "struct<kind:int, start:int, stop:int>"
_CASE = "struct<kind:int, start:int, stop:int, label:int, features:array<double>>"
_SCAN = f"base array<{_SPAN}>, cases array<{_CASE}>"


def _scan_text(text: str) -> tuple[list[dict], list[dict]]:
    """Base spans, and the cases: label 0 for open proposals, 1 for positives, 2 for negatives."""
    base = base_spans(text)
    cases = []

    def case(kind: int, start: int, stop: int, label: int, span: str) -> None:
        x = features(kind, span, text[max(0, start - 40) : start], text[stop : stop + 10])
        cases.append({"kind": kind, "start": start, "stop": stop, "label": label, "features": x})

    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = list(accumulate((b for _, b in taken), max))
    for kind, start, stop in proposals(text):
        if not _overlaps(starts, reach, start, stop):
            case(kind, start, stop, 0 if plausible(kind, text[start:stop]) else 2, text[start:stop])
    for kind, start, stop in base:
        rng = random.Random(zlib.crc32(text[start:stop].encode()) * 31 + start)
        span = text[start:stop]
        case(kind, start, stop, 1, span)
        case(kind, start, stop, 1, _rewritten(kind, span, rng))
        case(kind, start, stop, 1, _rewritten(kind, span, rng))
        case(kind, start, stop, 2, _damaged(kind, span, rng))
        case(kind, start, stop, 2, _damaged(kind, span, rng))
    return [{"kind": k, "start": a, "stop": b} for k, a, b in base], cases


def _overlaps(starts: list[int], reach: list[int], start: int, stop: int) -> bool:
    """Whether [start, stop) meets a base span; ``reach`` is the furthest end of the spans so far."""
    i = bisect.bisect_left(starts, stop)
    return i > 0 and reach[i - 1] > start


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
    case = pa.struct([*span, ("label", pa.int32()), ("features", pa.list_(pa.float64()))])
    for batch in batches:
        found = [_scan_text(x or "") for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x[0] for x in found], pa.list_(span)), pa.array([x[1] for x in found], pa.list_(case))],
            names=["doc_id", "base", "cases"],
        )


def _added(cases: DataFrame, scratch: Scratch, max_false: float, train_rows: int, seed: int) -> DataFrame | None:
    """(_at, kind, start, stop, score) of the proposals above the threshold of their kind."""
    marked = cases.withColumn("hash", F.xxhash64("kind", "start", "stop", "features", F.lit(seed)))
    known = marked.where("label > 0").select("kind", "features", (F.col("label") == 1).cast("double").alias("y"), "hash")
    held = F.pmod(F.shiftright("hash", 20), F.lit(3)) == 0
    sizes = {r.y: r.n for r in known.where(~held).groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    sample = known.where(~held).orderBy("hash").limit(train_rows)
    train = scratch.save(sample.select(array_to_vector("features").alias("x"), "y"), "train")
    model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=TREES, maxDepth=DEPTH, seed=seed, cacheNodeIds=False).fit(train)

    def scored(frame: DataFrame) -> DataFrame:
        out = model.transform(frame.withColumn("x", array_to_vector("features")))
        return out.withColumn("score", vector_to_array("probability")[1])

    # held-out negatives by score, in 1000 steps for each kind
    steps = (
        scored(known.where(held & (F.col("y") == 0)))
        .groupBy("kind", F.floor(F.col("score") * 1000).cast("int").alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    limits = {}
    for kind in range(len(KINDS)):
        count = {r.step: r.n for r in steps if r.kind == kind}
        allowed = max_false * (sum(count.values()) + 1) - 1
        above = 0
        for step in range(1000, 499, -1):
            above += count.get(step, 0)
            if above > allowed:
                break
            limits[kind] = step / 1000
    if not limits:
        return None
    limit = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
    proposed = scored(marked.where("label = 0"))
    return proposed.where(F.col("score") >= F.coalesce(limit[F.col("kind")], F.lit(2.0))).select("_at", "kind", "start", "stop", "score")


def _without_overlaps(score_first: str) -> str:
    """SQL: of spans in order of score the ones that don't meet an earlier one."""
    return (
        f"aggregate({score_first}, cast(array() AS array<{_SPAN}>), (kept, x) -> "
        "if(exists(kept, k -> k.start < x.stop AND x.start < k.stop), kept, "
        "concat(kept, array(named_struct('kind', x.kind, 'start', x.start, 'stop', x.stop)))))"
    )


def find_personal_data(
    docs: DataFrame, max_false: float = MAX_FALSE, train_rows: int = TRAIN_ROWS, seed: int = 3
) -> DataFrame:
    """Per row of ``docs``: doc_id, ``base`` and ``spans`` (arrays of kind number, start, stop).

    ``spans`` holds the base spans and those added, by kind and start, in code points. Added
    spans never overlap a base span or each other; the higher score wins, then the earlier
    start. The trees are fitted on at most ``train_rows`` cases chosen by hash; thresholds use all
    held-out cases. NULL and empty texts have no spans. Without base spans nothing is added, as there is
    nothing to learn from. Repeated ids and rows each give a row. Extra columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id {id_type}, {_SCAN}")
    scanned = found.withColumn("_at", F.monotonically_increasing_id())
    table = scratch.save(scanned, "scanned")
    cases = table.where("size(cases) > 0").select("_at", F.explode("cases").alias("c")).select("_at", "c.*")
    added = _added(cases, scratch, max_false, train_rows, seed)
    slim = table.select("_at", "doc_id", "base")
    if added is None:
        return slim.select("doc_id", "base", F.col("base").alias("spans"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "start", "stop", "kind")))
    per_row = added.groupBy(F.col("_at").alias("_row")).agg(ordered.alias("more"))
    per_row = per_row.withColumn("more", F.expr(_without_overlaps("more")))
    joined = slim.join(per_row, F.col("_at") == F.col("_row"), "left")
    spans = F.sort_array(F.concat("base", F.coalesce("more", F.expr(f"cast(array() AS array<{_SPAN}>)"))))
    return joined.select("doc_id", "base", spans.alias("spans"))


def spans_text(column: str) -> str:
    """SQL: ``kind:start:end`` of each span, comma-joined."""
    names = "array(" + ", ".join(f"'{x}'" for x in KINDS) + ")"
    return f"concat_ws(',', transform({column}, x -> concat_ws(':', {names}[x.kind], x.start, x.stop)))"


def redact(docs: DataFrame, **options) -> DataFrame:
    """doc_id and the text with every span replaced by its kind in brackets.

    Spans belong to a text, whatever its id: rows without an id, and different texts of one id, are
    each cut by their own spans. Every row of ``docs`` gives one row; a NULL text stays NULL.
    """
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("_key"))
    named = keyed.select(F.struct("doc_id", "_key").alias("doc_id"), "text")
    found = find_personal_data(named, **options).where("size(spans) > 0").select(
        F.col("doc_id.doc_id").alias("_id"), F.col("doc_id._key").alias("_text"), "spans"
    )
    # of overlapping spans the text is cut once, from the first start to the last end
    merged = F.expr(
        "aggregate(sort_array(transform(spans, x -> named_struct('start', x.start, 'stop', x.stop, 'kind', x.kind))), "
        "cast(array() AS array<struct<start:int, stop:int, kind:int>>), (m, x) -> "
        "if(size(m) > 0 AND element_at(m, -1).stop > x.start, concat(slice(m, 1, size(m) - 1), "
        "array(named_struct('start', element_at(m, -1).start, 'stop', greatest(element_at(m, -1).stop, x.stop), 'kind', element_at(m, -1).kind))), "
        "concat(m, array(x))))"
    )
    names = "array(" + ", ".join(f"'[{x}]'" for x in KINDS) + ")"
    cut = F.expr(
        "concat(aggregate(cuts, named_struct('at', 0, 'out', ''), (s, x) -> named_struct('at', x.stop, "
        f"'out', concat(s.out, substring(text, s.at + 1, x.start - s.at), {names}[x.kind]))).out, "
        "substring(text, element_at(cuts, -1).stop + 1, length(text)))"
    )
    # equal texts have equal spans
    once = found.groupBy("_id", "_text").agg(F.first("spans").alias("spans")).withColumn("cuts", merged)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text"))
    joined = keyed.join(once, same, "left")
    return joined.select("doc_id", F.when(F.col("cuts").isNotNull(), cut).otherwise(F.col("text")).alias("text"))
