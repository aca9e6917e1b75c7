"""Personal data: exact base patterns, and contexts learned from what they find.

Base patterns find emails, IP addresses, card numbers and phone numbers in whole texts.  They are the
seeds of a bootstrap:

1.  Every identifier-like expression (a base match, or one that looks like a kind but fails its pattern: a
    card number that fails Luhn, a phone number without its plus sign, an address written with ``(at)`` or
    ``[.]``, ...) is an instance.  The words around it are lexical patterns: the two words before it, the
    two after it, and one on either side.
2.  Patterns and instances make a graph.  Spark scores it in ``rounds``: an instance's belief in a kind is 1
    for a seed and else 1 - product(1 - confidence) over its patterns; a pattern's confidence in a kind is
    the belief in that kind over its distinct instances, divided by their number plus ``prior``.  A
    pattern needs ``support`` distinct seeds or believed instances.
3.  An instance that is no base match becomes a span of its kind if its belief reaches ``accept``.  Base
    spans always stay; a new span that overlaps a base span or an earlier new one is left out.

4.  The patterns that could bring an instance to ``accept`` (of over ``PATTERNS``, block by block) go to a second
    scan.  There whatever stands in the slot of such a pattern is an instance of its kind, however it is
    spelled: only a wide check by kind (:data:`DIGIT_COUNTS`, :data:`WIDE`) is asked for.  The graph with these instances is
    scored again, from the confidence of the first time.  Other runs of digits are looked up among the believed instances.

The texts are read twice (once if no pattern is that confident).  What they leave behind (spans, instances and their
contexts) is written as a table, so the rounds never see texts.  The edges are counted per pattern by partial aggregation, so a context that a
third of all rows share is one row after each task's own sums.

Defined cases: a null text is an empty one, without spans; null and repeated ids are rows of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ticklake.llm.common import by_batch, written

KINDS = ("email", "ip", "card", "phone")
# The base patterns (the starts are guarded so that a long run is looked at once).
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++")

# What may be an identifier though it is no base match.
LOOSE = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\]|\{at\})\s?[\w-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\}|\[\.\])\s?[\w-]{1,63}){1,4}(?![\w@])", re.I),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![\w.])", re.I),
    "card": re.compile(r"(?<![\w+.])[0-9]{4}(?:([ .-]?)[0-9]{4})(?:\1[0-9]{4}){1,2}\1?[0-9]{1,4}(?![\w.]\w|\w)"),
    "phone": re.compile(r"(?<![\w+.(])\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}(?:[ .-][0-9]{2,4}){1,3}(?!\w)"),
}
# What may stand in a pattern's slot: the spelling is free.  Digits of a number are at most three marks apart, on one line.
RUN = re.compile(r"(?<!\w)[(+]?[0-9](?:[ \t().+/-]{0,3}+[0-9])*+")
GAP = re.compile(r"[ \t]+")
DIGIT_COUNTS = {"card": (12, 19), "phone": (7, 15)}
WIDE = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}(?:[ \t]?[\[({<][ \t]?at[ \t]?[\])}>][ \t]?|[ \t]at[ \t]|[ \t]?[@#\uff20][ \t]?)[\w-]{1,63}"
                        r"(?:(?:[ \t]?[\[({<][ \t]?(?:dot|\.)[ \t]?[\])}>][ \t]?|[ \t]dot[ \t]|\.)[\w-]{1,63}){0,6}", re.I),
    "ip": re.compile(r"(?<![\w.:])(?:[0-9]{1,3}(?:[ \t]?(?:[\[({<][ \t]?(?:dot|\.)[ \t]?[\])}>]|dot|[.,:/_-])[ \t]?[0-9]{1,3}|[ \t][0-9]{1,3}){3}"
                     r"|(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}|(?:[0-9a-f]{1,4}:){1,6}(?::[0-9a-f]{1,4}){1,6})(?!\w)", re.I),
}
#: Patterns that one task holds; more of them are scanned for in blocks (:func:`placed`).
PATTERNS = 100_000
HINTS = re.compile(r"@|\((?:at|\.)|\[(?:at|dot|\.)|\{at", re.I)
BEFORE = re.compile(r"(\S+)?[^\S\n]*(\S+)?[^\S\n]*$")
AFTER = re.compile(r"[^\S\n]*(\S+)?[^\S\n]*(\S+)?")
REACH = 80


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses.  Each is found from its @: no other character can end the local part."""
    out, after, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > after and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            after = domain.end()
            out.append((begin, after))
        at = text.find("@", max(at + 1, after))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text)
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def _context(text: str, begin: int, end: int) -> tuple[list[str], list[str]]:
    """Up to two lower-case words on either side, on the same line.  A word that does not end within ``REACH``
    characters is none, nor is what lies behind it: no word is cut."""
    near = text[max(0, begin - REACH):begin]
    if begin > REACH and not text[begin - REACH - 1].isspace():
        near = near[len(near.split(None, 1)[0]) if near[:1].strip() else 0:]
    left = near.rpartition("\n")[2].lower().split()[-2:]
    near = text[end:end + REACH]
    if end + REACH < len(text) and not text[end + REACH].isspace() and near[-1:].strip():
        near = near[:len(near) - len(near.rsplit(None, 1)[-1])]
    right = near.partition("\n")[0].lower().split()[:2]
    return left, right


def patterns(left: list[str], right: list[str]) -> list[str]:
    out = []
    if len(left) == 2:
        out.append("L " + " ".join(left))
    if len(right) == 2:
        out.append("R " + " ".join(right))
    if left and right:
        out.append(f"B {left[-1]} _ {right[0]}")
    return out


class Known:
    """Confident patterns: what they say about the kind of what stands between two places of a text."""

    def __init__(self, rows: list[tuple[str, str, float]]):
        self.by_pattern: dict[str, dict[str, float]] = {}
        for pattern, kind, confidence in rows:
            self.by_pattern.setdefault(pattern, {})[kind] = confidence
        self.kinds = {kind for _, kind, _ in rows}

    def strengths(self, left: list[str], right: list[str]) -> dict[str, float]:
        """Noisy-or of the patterns' confidence, by kind."""
        open_: dict[str, float] = {}
        for pattern in patterns(left, right):
            for kind, confidence in self.by_pattern.get(pattern, {}).items():
                open_[kind] = open_.get(kind, 1.0) * (1 - confidence)
        return {kind: 1 - x for kind, x in open_.items()}


def slots(text: str, known: Known) -> tuple[list[tuple[float, str, int, int]], list[tuple[str, int, int]]]:
    """(strength, kind, start, end) of what stands in the slot of a known pattern, and (kind, start, end) of whole runs of digits."""
    found, runs = [], []
    given = isinstance(known, Given)
    if known.kinds & DIGIT_COUNTS.keys():
        for m in RUN.finditer(text):
            total = sum(map(str.isdigit, m[0]))
            if total < 7:
                continue
            if given:
                runs += [(k, m.start(), m.end()) for k, (low, high) in DIGIT_COUNTS.items() if low <= total <= high]
                continue
            gaps = [(g.start() + m.start(), g.end() + m.start()) for g in GAP.finditer(m[0])]
            begins, ends = [m.start()] + [g[1] for g in gaps], [g[0] for g in gaps] + [m.end()]
            counts = [sum(map(str.isdigit, text[a:b])) for a, b in zip(begins, ends)]
            rights: dict[int, list[str]] = {}
            runs += [(k, m.start(), m.end()) for k, (low, high) in DIGIT_COUNTS.items() if low <= total <= high]
            for i, begin in enumerate(begins):  # parts i to j: at most 19 digits, so the work is linear
                left, n = None, 0
                for j in range(i, min(i + 40, len(ends))):
                    n += counts[j]
                    if n > 19:
                        break
                    if n < 7:
                        continue
                    left = _context(text, begin, begin)[0] if left is None else left
                    end = ends[j]
                    if end not in rights:
                        rights[end] = _context(text, end, end)[1]
                    for kind, strength in known.strengths(left, rights[end]).items():
                        low, high = DIGIT_COUNTS.get(kind, (1, 0))
                        if low <= n <= high:
                            found.append((strength, kind, begin, end))
    if given:
        return known.found, runs
    for kind, wide in WIDE.items():
        if kind in known.kinds:
            for m in wide.finditer(text):
                strength = known.strengths(*_context(text, m.start(), m.end())).get(kind)
                parts = re.findall("[0-9]+", m[0])
                if strength and (kind != "ip" or len(parts) != 4 or ":" in m[0] or all(int(x) <= 255 for x in parts)):
                    found.append((strength, kind, m.start(), m.end()))
    return found, runs


class Given:
    """What patterns say about the places of one text, worked out before."""

    def __init__(self, found: list[tuple[float, str, int, int]], kinds: set[str]):
        self.found, self.kinds = found, kinds


def _normal(kind: str, found: str) -> str:
    if kind == "email" or kind == "ip" and re.search("[a-f:]", found, re.I) and not re.search("dot", found, re.I):
        return "".join(found.lower().split())
    return re.sub(r"[^0-9]", "", found)


def instances(text: str, base: list[tuple[str, int, int]], digits: bool, known: Known | Given | None = None) -> list[tuple[str, int, int, bool, str, list[str]]]:
    """(kind, start, end, is base, normal form, patterns) of every identifier-like expression.

    With ``known`` also of what stands in the slot of a known pattern, which goes before other expressions, and, without
    patterns, of the remaining runs of digits.
    """
    found = [(k, a, b, True) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)

    def free(begin: int, end: int) -> bool:
        at = bisect_left(clear, (end, 0))
        return at == 0 or clear[at - 1][1] <= begin

    def add(x: tuple[str, int, int, bool]) -> None:
        insort(clear, (x[1], x[2]))
        found.append(x)

    clear: list[tuple[int, int]] = []  # what is taken, merged where base spans overlap
    for a, b in taken:
        if clear and a < clear[-1][1]:
            clear[-1] = (clear[-1][0], max(b, clear[-1][1]))
        else:
            clear.append((a, b))
    in_slots, runs = slots(text, known) if known else ([], [])
    for _, kind, a, b in sorted(in_slots, key=lambda x: (-x[0], x[2] - x[3], x[2], x[1])):
        if free(a, b):
            add((kind, a, b, False))
    loose = []
    hints = HINTS.search(text) is not None
    for kind, pattern in LOOSE.items():
        if kind in ("email", "ip") and not hints or kind in ("card", "phone") and not digits:
            continue
        for m in pattern.finditer(text):
            n = sum("0" <= c <= "9" for c in m[0])
            if kind == "email" or kind == "ip" or kind == "card" and 13 <= n <= 19 or kind == "phone" and 7 <= n <= 12:
                loose.append((kind, m.start(), m.end(), False))
    for x in sorted(loose, key=lambda x: (x[1], -x[2])):
        if free(x[1], x[2]):
            add(x)
    bare = [(k, a, b, False) for k, a, b in runs if free(a, b)]  # both kinds of a run: at most one is believed in the end
    out = []
    for kind, a, b, is_base in found:
        out.append((kind, a, b, is_base, _normal(kind, text[a:b]), patterns(*_context(text, a, b))))
    return out + [(kind, a, b, False, _normal(kind, text[a:b]), []) for kind, a, b, _ in bare]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
SEEN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()), ("normal", pa.string()),
                  ("patterns", pa.list_(pa.string()))])
DIGITS = re.compile(r"[0-9][0-9 ().-]{5}")


PLACE = pa.struct([("strength", pa.float64()), ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
PLACES = "array<struct<strength:double,kind:string,start:bigint,stop:bigint>>"


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def placed(df: DataFrame, text_col: str, able: DataFrame, count: int) -> tuple[DataFrame, set[str]]:
    """(digest, places) of every text that has slots of more patterns than one task should hold, and the patterns' kinds.

    The patterns are dealt to blocks of about half of ``PATTERNS``; the texts are scanned once a block.  A place's strength
    is one less the product of what each block's patterns leave open, so the blocks together say what all patterns at
    once would.  Equal texts have equal places and are worked out once.
    """
    blocks = -(-2 * count // PATTERNS)
    dealt = written(able.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(blocks))), "pii-blocks")
    texts = df.select(_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"))
    found = []
    for block in range(blocks):
        rows = [tuple(r) for r in dealt.where(F.col("block") == block).select("pattern", "kind", "confidence").collect()]
        if not rows:
            continue

        def make(rows=rows):
            known = Known(rows)

            def step(columns):
                names = ("strength", "kind", "start", "stop")
                return {"digest": columns[0], "places": pa.array([[dict(zip(names, x)) for x in slots(t or "", known)[0]] for t in columns[1].to_pylist()],
                                                                 type=pa.list_(PLACE))}

            return step

        scan = by_batch(texts, make, f"digest binary, places {PLACES}")
        found.append(written(scan.select("digest", F.explode("places").alias("p")).select("digest", "p.*").distinct(), "pii-block-places"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    strength = 1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("strength"), F.lit(1e-300)))))
    whole = every.groupBy("digest", "kind", "start", "stop").agg(strength.alias("strength")) \
        .groupBy("digest").agg(F.collect_list(F.struct("strength", "kind", "start", "stop")).alias("places"))
    return written(whole, "pii-places"), {r["kind"] for r in dealt.select("kind").distinct().collect()}


def scanned(df: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None, rows: list[tuple[str, str, float]] | None = None,
            places: tuple[DataFrame, set[str]] | None = None) -> DataFrame:
    """(doc_id, base spans, instances) of every text, and the columns ``keep`` as kept_0, kept_1, ...  No shuffle.

    With ``rows`` (pattern, kind, confidence) also instances in the slots of these patterns; with ``places``, those
    of :func:`placed`, joined with the texts.
    """
    keep = keep or []
    told = df.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)])
    joined = places is not None
    if joined:
        told = told.join(places[0].select(F.col("digest").alias("_digest"), F.col("places").alias("_places")),
                         _digest(F.col("_text")) == F.col("_digest"), "left").drop("_digest")
        kinds_known = places[1]

    def make():
        pattern_table = Known(rows) if rows else None

        def step(columns):
            base, seen = [], []
            given = columns[-1].to_pylist() if joined else None
            for n, text in enumerate(columns[1].to_pylist()):
                text = text or ""
                own = base_spans(text)
                if given is not None:
                    known = Given([(p["strength"], p["kind"], p["start"], p["stop"]) for p in given[n] or []], kinds_known)
                else:
                    known = pattern_table
                base.append([{"kind": k, "start": a, "stop": b} for k, a, b in own])
                seen.append([dict(zip(("kind", "start", "stop", "base", "normal", "patterns"), x))
                             for x in instances(text, own, DIGITS.search(text) is not None, known)])
            return {"doc_id": columns[0], "base": pa.array(base, type=pa.list_(SPAN)), "seen": pa.array(seen, type=pa.list_(SEEN)),
                    **{f"kept_{i}": columns[2 + i] for i in range(len(keep))}}

        return step

    kinds = dict(df.dtypes)
    schema = ["doc_id bigint", "base array<struct<kind:string,start:bigint,stop:bigint>>",
              "seen array<struct<kind:string,start:bigint,stop:bigint,base:boolean,normal:string,patterns:array<string>>>"]
    schema += [f"kept_{i} {kinds[c]}" for i, c in enumerate(keep)]
    return by_batch(told, make, ", ".join(schema))


def score(edges: DataFrame, rounds: int, support: float, prior: float, start: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(normal, kind, belief) of the instances that are no seeds, and (pattern, kind, confidence), from edges (pattern, kind, normal, base).

    An edge says that the pattern occurs around the instance; its kind is the instance's.  ``start`` has the
    confidence that the first beliefs come from.
    """
    edges = written(edges.groupBy("pattern", "kind", "normal").agg(F.max("base").alias("base")), "pii-edges")

    def believed_by(confidence: DataFrame) -> DataFrame:
        # noisy-or, with the logarithm kept finite for certain patterns
        open_ = edges.where(~F.col("base")).join(confidence, ["pattern", "kind"])
        return written(open_.groupBy("kind", "normal").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("belief")), "pii-beliefs")

    beliefs = None if start is None else believed_by(start)
    for _ in range(rounds):
        believed = edges.withColumn("belief", F.col("base").cast("double"))
        if beliefs is not None:
            believed = edges.join(beliefs, ["kind", "normal"], "left") \
                .withColumn("belief", F.when(F.col("base"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0))))
        # an instance of another kind speaks against the pattern
        kinds = believed.groupBy("pattern", "kind").agg(F.sum("belief").alias("for"), F.count(F.lit(1)).alias("n"))
        totals = kinds.groupBy("pattern").agg(F.sum("n").alias("all"))
        scored = kinds.join(totals, "pattern").where(F.col("for") >= support) \
            .select("pattern", "kind", (F.col("for") / (F.col("all") + F.lit(prior))).alias("confidence"))
        confidence = written(scored, "pii-patterns")
        beliefs = believed_by(confidence)
    return beliefs, confidence


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, support: float = 3.0, prior: float = 1.0,
         accept: float = 0.75) -> DataFrame:
    """(doc_id, base, spans) of every row: base spans, and all spans, each by kind as listed, then start."""
    return with_spans(df, id_col, text_col, None, rounds, support, prior, accept).select("doc_id", "base", "spans")


def with_spans(df: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None, rounds: int = 3, support: float = 3.0, prior: float = 1.0,
               accept: float = 0.75) -> DataFrame:
    """The rows of :func:`scanned` with a number ``row`` and ``spans``."""
    def scan(rows: list[tuple[str, str, float]] | None = None, places: tuple[DataFrame, set[str]] | None = None) -> tuple[DataFrame, DataFrame]:
        found = written(scanned(df, id_col, text_col, keep, rows, places).withColumn("row", F.monotonically_increasing_id()), "pii-scan")
        return found, found.where(F.size("seen") > 0).select("row", F.explode("seen").alias("s")).select("row", "s.*")

    def edges(seen: DataFrame) -> DataFrame:
        return seen.select(F.explode("patterns").alias("pattern"), "kind", "normal", "base")

    rows, seen = scan()
    beliefs, confidence = score(edges(seen), rounds, support, prior)
    # three patterns surround an instance: if all are below this, they cannot bring it to ``accept``
    able = confidence.where(F.col("confidence") >= 1 - (1 - accept) ** (1 / 3))
    count = able.count()
    if count:
        if count <= PATTERNS:
            rows, seen = scan([tuple(r) for r in able.select("pattern", "kind", "confidence").collect()])
        else:
            rows, seen = scan(places=placed(df, text_col, able, count))
        beliefs, _ = score(edges(seen), rounds, support, prior, confidence)
    new = seen.where(~F.col("base")).join(beliefs.where(F.col("belief") >= accept).select("kind", "normal", "belief"), ["kind", "normal"]) \
        .groupBy("row", "start", "stop").agg(F.max_by("kind", F.struct("belief", "kind")).alias("kind"))
    new = written(new.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("added")), "pii-added")
    place = F.array(*(F.lit(k) for k in KINDS))
    joined = rows.join(new.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    both = F.concat("base", F.coalesce("added", F.expr("cast(array() as array<struct<kind:string,start:bigint,stop:bigint>>)")))
    ordered = F.array_sort(F.transform(both, lambda s: F.struct(F.array_position(place, s["kind"]).alias("k"), s["start"].alias("a"), s["stop"].alias("b"))))
    return joined.withColumn("spans", F.transform(ordered, lambda s: F.struct(F.element_at(place, s["k"].cast("int")).alias("kind"),
                                                                              s["a"].alias("start"), s["b"].alias("stop"))))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and the list of all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (overlaps merged) replaced by its kind in brackets."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """``df`` with every span found in its text replaced by its kind.  Rows without spans stay as they are.

    The texts travel with the scan's table, so that a row and its spans meet without an id.
    """
    names = df.columns
    found = with_spans(df, id_col, text_col, names)
    texts = names.index(text_col)

    def make():
        def step(columns):
            spans = [[(s["kind"], s["start"], s["stop"]) for s in x] for x in columns[1].to_pylist()]
            return {"row": columns[0], "text": pa.array([redacted(t or "", s) if s else t for t, s in zip(columns[2].to_pylist(), spans)], type=pa.string()),
                    "changed": pa.array([bool(s) for s in spans]), **{f"kept_{i}": c for i, c in enumerate(columns[3:])}}

        return step

    kinds = dict(df.dtypes)
    new = by_batch(found.select("row", "spans", f"kept_{texts}", *[f"kept_{i}" for i in range(len(names))]), make,
                   ", ".join(["row bigint", "text string", "changed boolean"] + [f"kept_{i} {kinds[c]}" for i, c in enumerate(names)]))
    out = []
    for i, name in enumerate(names):
        if name == text_col:
            out.append(F.col("text").alias(name))
        elif name == count_col:
            out.append(F.when(F.col("changed"), F.length("text")).otherwise(F.col(f"kept_{i}")).cast(kinds[name]).alias(name))
        else:
            out.append(F.col(f"kept_{i}").alias(name))
    return new.select(*out)
