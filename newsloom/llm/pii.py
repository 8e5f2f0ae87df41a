"""Personal data in texts, with DataFrame functions only.

Base patterns with their format checks give spans that always count. Three high-recall generators propose further
candidates, which may overlap them and each other: addresses however written out (contact), phone numbers without a
plus (local), long numbers with any separators (number). Boosted trees over format and context features score them.

What the trees learn from isn't what they choose among. Positives are candidates that a validated base span covers (an
email for contact, a phone for local, a card for number), with what made it valid hidden: the at sign and dots are read
like their written-out forms, the plus and country code lie outside the candidate and its context, the checksum is no
feature. Negatives are hard ones with a reason of their own (``_refuted``): sentence ends, dates, prices, versions,
failing checksums, octets. All others are unlabelled; only those can be chosen, so a span is added where an unlabelled
candidate looks and stands like validated data and unlike the refuted.

Features are discrete, so training needs only counts by feature cell over all documents (at most CELLS rows a fold reach
the driver, whatever the input). Each generator's threshold is calibrated over all documents, each scored by trees that
didn't see its fold: the lowest score from which the precision's lower bound reaches ``precision``; without enough
labelled candidates there is none, and nothing is added.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Java forms of the base patterns: possessive, and anchored so that long runs are tried once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
_AT = r"\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?"
_DOT = r"\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?"
GENERATORS = {
    "contact": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)(?:(?:\.|\(dot\)|\[dot\]|\x20dot\x20)[A-Za-z0-9-]++)*+",
    "local": r"(?<![0-9A-Za-z.])[(]?[0-9]{2,4}[)]?[\x20./-]{1,2}[0-9]{3,4}[\x20./-]{1,2}[0-9]{3,4}(?![0-9A-Za-z])",
    "number": r"(?<![0-9A-Za-z.])[0-9]++(?:[\x20./_-]{1,2}[0-9]++)*+(?![0-9A-Za-z])",
}
#: Base kind that makes a candidate of each generator a positive example.
POSITIVE = {"contact": "email", "local": "phone", "number": "card"}
CONTEXT = 24
#: Matches whose places are added up at once; spans that are looked through one by one, more are halved.
BLOCK = 64
FEW_SPANS = 12
#: Feature name -> number of its values.
FEATURES = {"kind": 3, "shape": 5, "parts": 5, "first": 3, "context": 5, "line": 2, "length": 4}
CELLS = math.prod(FEATURES.values())
ROUNDS = 40
RATE = 0.3
FOLDS = 5
PRECISION = 0.95

_OCTET = r"^0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
_SPAN = "struct<begin:int,end:int,value:string,before:string>"


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the lambdas in the body use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: begin and end in code points, the match, what stands before it.

    Places add up over gaps and matches. A fold that appends copies what it has, so it runs over blocks of BLOCK matches,
    and over the blocks' lengths: the work follows the number of matches.
    """
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    empty = F.array().cast(f"array<{_SPAN}>")

    def block(m: Column, b: Column) -> Column:
        """Matches of block b with places from the block's begin, and its length."""

        def step(acc: Column, i: Column) -> Column:
            gap, value = F.element_at(m["gaps"], i), F.element_at(m["found"], i)
            begin = acc["at"] + F.char_length(gap)
            end = begin + F.char_length(value)
            one = F.struct(begin.alias("begin"), end.alias("end"), value.alias("value"), F.right(gap, F.lit(CONTEXT)).alias("before"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        own = F.sequence(b * BLOCK + 1, F.least((b + 1) * BLOCK, F.size(m["found"])))
        return F.aggregate(own, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)

    def placed(blocks: Column) -> Column:
        def sums(acc: Column, x: Column) -> Column:
            return F.concat(acc, F.array(F.element_at(acc, -1) + x["at"]))

        def moved(starts: Column) -> Column:
            shift = lambda x, by: F.struct((x["begin"] + by).alias("begin"), (x["end"] + by).alias("end"), x["value"].alias("value"), x["before"].alias("before"))
            return F.flatten(F.transform(blocks, lambda x, i: F.transform(x["out"], lambda y: shift(y, F.element_at(starts, i + 1)))))

        one = F.size(blocks) == 1
        return F.when(one, F.element_at(blocks, 1)["out"]).otherwise(_with(F.aggregate(blocks, F.array(F.lit(0)), sums), moved))

    def found(m: Column) -> Column:
        last = F.floor((F.size(m["found"]) - 1) / BLOCK).cast("int")
        return F.when(F.size(m["found"]) == 0, empty).otherwise(_with(F.transform(F.sequence(F.lit(0), last), lambda b: block(m, b)), placed))

    return _with(both, found)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""

    def step(acc: Column, i: Column) -> Column:
        d = F.substr(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), step) % 10 == 0


def _digits(x: Column) -> Column:
    return F.regexp_replace(x["value"], "[^0-9]", "")


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x["value"], r"\."), lambda p: p.rlike(_OCTET))
    n = F.char_length(_digits(x))
    if kind == "card":
        return n.between(13, 19) & luhn(_digits(x))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Spans of a base kind that pass its format check; texts that can't hold one are passed over."""
    can = {
        "email": F.contains(text, F.lit("@")),
        "ip": F.contains(text, F.lit(".")) & text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike("[0-9]"),
        "phone": F.contains(text, F.lit("+")),
    }[kind]
    found = F.filter(matches(text, PATTERNS[kind]), lambda x: _valid(kind, x))
    return F.when(can, found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def candidates(text: Column, kind: str) -> Column:
    if kind == "contact":
        # one of these stands in every match
        can = F.contains(text, F.lit("@")) | F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]")) | F.contains(text, F.lit(" at "))
    else:
        can = text.rlike("[0-9]")
    found = matches(text, GENERATORS[kind])
    if kind == "number":
        found = F.filter(found, lambda x: F.char_length(_digits(x)).between(13, 19))
    return F.when(can, found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _before(x: Column) -> Column:
    """The context in front, in lower case, without a plus and country code at its end."""
    return F.regexp_replace(F.lower(x["before"]), r"\+[0-9]{0,3}[\x20().-]*$", "")


def _refuted(kind: str, x: Column) -> Column:
    """Whether a candidate is a hard negative."""
    value, before = x["value"], _before(x)
    if kind == "contact":  # "we met at noon. Then": a full stop that ends a sentence
        return value.rlike(r"\.\x20")
    price = before.rlike(r"(?:[$€£¥]|\b(?:usd|eur|gbp|price|cost|total)\W{0,3})$")
    version = before.rlike(r"(?:\bv|version|release|build|\bver\.?|\bsection|\bchapter|\bno\.?|#)\W{0,2}$")
    if kind == "number":
        return price | version | ~luhn(_digits(x))
    date = value.rlike(r"^(?:(?:19|20)[0-9]{2}|[0-3]?[0-9])[\x20./-]{1,2}[0-3]?[0-9]{1,2}[\x20./-]{1,2}(?:19|20)[0-9]{2}$") | value.rlike(
        r"^(?:19|20)[0-9]{2}[\x20./-]{1,2}(?:19|20)[0-9]{2}[\x20./-]"
    )
    return price | version | date


def _features(kind: str, x: Column) -> Column:
    """The discrete features of a candidate."""
    value, before = x["value"], _before(x)
    bucket = lambda c, *cuts: sum((F.when(c >= k, 1).otherwise(0) for k in cuts), F.lit(0))
    words = [r"(?:call|phone|tel|mobile|fax|ring|dial)\W*(?:\w+\W+)?$", r"(?:mail|contact|write|reach|ask)\W*(?:\w+\W+)?$", r"(?:card|visa|account|iban|pay)\W*(?:\w+\W+)?$", r"(?:ip|host|server|address|login)\W*(?:\w+\W+)?$"]
    context = F.coalesce(*[F.when(before.rlike(w), F.lit(i + 1)) for i, w in enumerate(words)], F.lit(0))
    if kind == "contact":
        name, end = F.regexp_extract(value, r"^[A-Za-z0-9._%+-]+", 0), F.lower(F.regexp_extract(value, r"[A-Za-z0-9-]+$", 0))
        shape = F.when(name.rlike("[0-9]"), 3).when(name.rlike(r"[A-Za-z][._%+-]+[A-Za-z]"), 2).when(F.char_length(name) > 3, 1).otherwise(0)
        # the end of the host: a generic domain, two letters, something else
        parts = F.when(end.isin("com", "org", "net", "edu", "gov", "io", "info", "biz", "dev", "app"), 2).when(end.rlike("^[a-z]{2}$"), 1).otherwise(0)
        first = F.when(name.rlike("^[a-z]"), 0).when(name.rlike("^[A-Z]"), 1).otherwise(2)
        length = bucket(F.char_length(F.regexp_replace(value, rf"{_AT}|{_DOT}", "")), 8, 14, 22)
    else:
        sizes = F.transform(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)), lambda g: F.char_length(g).cast("string"))
        own = F.array_join(sizes, "-")
        shape = F.when(own.rlike(r"^3-3-4$"), 1).when(own.rlike(r"^4(?:-4)+$"), 2).when(F.size(sizes) == 1, 0).when(own.rlike(r"^4-6-5$|^2-4-4$|^3-4-4$"), 3).otherwise(4)
        parts = bucket(F.size(sizes), 2, 3, 4, 5)
        digit = F.regexp_extract(value, "[0-9]", 0)
        first = F.when(digit.isin("4", "5"), 2).when(digit.isin("3", "6"), 1).otherwise(0)
        length = bucket(F.char_length(_digits(x)), 10, 13, 16)
    out = {
        "kind": F.lit(list(GENERATORS).index(kind)), "shape": shape, "parts": parts, "first": first, "context": context,
        "line": F.when(before.rlike(r"(?:^|\n)\s*$"), 1).otherwise(0), "length": length,
    }
    return F.struct(*[v.cast("int").alias(k) for k, v in out.items()])


class Trees:
    """Boosted regression trees of two levels on the logistic loss, over weighted cells of discrete features."""

    def __init__(self, cells: list[tuple[tuple[int, ...], int, int]], rounds: int = ROUNDS, rate: float = RATE):
        x = np.array([c[0] for c in cells], np.int64).reshape(-1, len(FEATURES))
        pos, neg = (np.array([c[i] for c in cells], float) for i in (1, 2))
        self.start, self.rate = math.log((pos.sum() + 1) / (neg.sum() + 1)), rate
        self.trees: list[tuple] = []
        margin = np.full(len(cells), self.start)
        for _ in range(rounds if pos.sum() and neg.sum() else 0):
            q = 1 / (1 + np.exp(-margin))
            g, h = pos - (pos + neg) * q, (pos + neg) * q * (1 - q) + 1e-9
            tree = self._grow(x, g, h, np.ones(len(cells), bool), 2)
            if not isinstance(tree, tuple):
                break
            self.trees.append(tree)
            margin = margin + rate * np.array([self._leaf(tree, c[0]) for c in cells])

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, at: np.ndarray, depth: int):
        gain = lambda a, b: a * a / (b + 1.0)
        total, weight = g[at].sum(), h[at].sum()
        leaf = float(total / (weight + 1.0))
        if not depth:
            return leaf
        best = None
        for f, values in enumerate(FEATURES.values()):
            a, b, n = (np.cumsum(np.bincount(x[at, f], w, values)) for w in (g[at], h[at], None))
            for v in range(1, values):  # below v, and from v on
                if 0 < n[v - 1] < n[-1]:
                    won = gain(a[v - 1], b[v - 1]) + gain(total - a[v - 1], weight - b[v - 1]) - gain(total, weight)
                    if best is None or won > best[0] + 1e-12:
                        best = (won, f, v)
        if best is None or best[0] <= 1e-6:
            return leaf
        _, f, v = best
        low = at & (x[:, f] < v)
        return (f, v, self._grow(x, g, h, low, depth - 1), self._grow(x, g, h, at & ~low, depth - 1))

    def _leaf(self, tree, x):
        while isinstance(tree, tuple):
            f, v, low, high = tree
            tree = high if x[f] >= v else low
        return tree

    def margin(self, x: tuple[int, ...]) -> float:
        return self.start + sum(self.rate * self._leaf(t, x) for t in self.trees)

    def column(self, x: Column) -> Column:
        """The margin of a features struct as an expression."""
        names = list(FEATURES)

        def of(tree):
            if not isinstance(tree, tuple):
                return F.lit(self.rate * tree)
            f, v, low, high = tree
            return F.when(x[names[f]] >= v, of(high)).otherwise(of(low))

        return sum((of(t) for t in self.trees), F.lit(self.start))


def lower_bound(good: int, n: int, z: float = 1.96) -> float:
    """Wilson's lower bound of a proportion."""
    if not n:
        return 0.0
    p = good / n
    return (p + z * z / 2 / n - z * math.sqrt(p * (1 - p) / n + z * z / 4 / n / n)) / (1 + z * z / n)


def calibrated(scored: list[tuple[float, int, int]], precision: float) -> float:
    """The lowest margin of a right one from which the precision of (margin, right, wrong) is sure enough; infinity if there is none."""
    ranked = sorted(scored, reverse=True)
    best, good, all_, i = math.inf, 0, 0, 0
    while i < len(ranked):
        m, before = ranked[i][0], good
        while i < len(ranked) and ranked[i][0] == m:
            good, all_, i = good + ranked[i][1], all_ + ranked[i][1] + ranked[i][2], i + 1
        if good > before and lower_bound(good, all_) >= precision:
            best = m
    return best


def cross_fitted(table: dict[int, list[tuple[tuple[int, ...], int, int]]], precision: float) -> tuple[Trees, dict[str, float]]:
    """(trees over all folds' cells, threshold of each generator), thresholds from scores of trees that didn't see the fold."""
    summed: dict[tuple[int, ...], list[int]] = {}
    for cells in table.values():
        for x, p, n in cells:
            own = summed.setdefault(x, [0, 0])
            own[0], own[1] = own[0] + p, own[1] + n
    scored: dict[int, list[tuple[float, int, int]]] = {i: [] for i in range(len(GENERATORS))}
    for fold, cells in table.items():
        left = {x: list(v) for x, v in summed.items()}
        for x, p, n in cells:
            left[x] = [left[x][0] - p, left[x][1] - n]
        trees = Trees([(x, p, n) for x, (p, n) in sorted(left.items()) if p or n])
        for x, p, n in cells:
            scored[x[0]].append((round(trees.margin(x), 9), p, n))
    trees = Trees([(x, p, n) for x, (p, n) in sorted(summed.items())])
    return trees, {k: calibrated(scored[i], precision) for i, k in enumerate(GENERATORS)}


def _overlaps(c: Column, spans: Column | str) -> Column:
    """Whether c meets one of the spans, which are in order and don't overlap: the first that ends behind c's begin decides."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    each = F.exists(spans, lambda b: (b["begin"] < c["end"]) & (c["begin"] < b["end"]))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        behind, done = F.element_at(spans, middle + 1)["end"] > c["begin"], acc["low"] >= acc["high"]
        low = F.when(done | behind, acc["low"]).otherwise(middle + 1)
        high = F.when(~done & behind, middle).otherwise(acc["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + F.lit(1.0))).cast("int"))
    range_ = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    first = F.aggregate(steps, range_, halve, lambda acc: acc["low"])
    return F.when(F.size(spans) <= FEW_SPANS, each).otherwise(F.coalesce(F.try_element_at(spans, first + 1)["begin"] < c["end"], F.lit(False)))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """doc_id and spans (kind, begin, end: code points, end exclusive) of every whole text, one row for each row.

    Base kinds email, ip, card and phone come first, in this order, each by begin; then what the trees select, as
    contact, local or number; these overlap no base span, and local spans no number candidate. Null and empty texts have
    no span; ids may be null or repeat; a table without rows gives none; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    plain = lambda a: F.transform(a, lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end")))

    def described(k: str) -> Column:
        one = lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), _features(k, x).alias("x"), _refuted(k, x).alias("refuted"))
        return F.transform(candidates(F.col("text"), k), one).alias(k)

    def named(a: Column | str, k: str) -> Column:
        return F.transform(a, lambda c: F.struct(F.lit(k).alias("kind"), c["begin"].alias("begin"), c["end"].alias("end")))

    rows = rows.select(
        "doc_id",
        F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"),
        *[plain(base_spans(F.col("text"), k)).alias(k) for k in KINDS],
        *[described(k) for k in GENERATORS],
    )
    rows = materialise(rows, "spans")

    def over(c: Column) -> Column:
        return _overlaps(c, "email") | _overlaps(c, "ip") | _overlaps(c, "card") | _overlaps(c, "phone")

    def examples(k: str) -> Column:
        """The labelled candidates: hit where a base span of the right kind covers it, else refuted ones."""
        hit = lambda c: _overlaps(c, POSITIVE[k])
        refuted = lambda c: c["refuted"] & ~over(c)
        return F.transform(F.filter(k, lambda c: hit(c) | refuted(c)), lambda c: F.struct(c["x"].alias("x"), hit(c).alias("hit")))

    cells = rows.select("fold", F.explode(F.concat(*map(examples, GENERATORS))).alias("c")).groupBy("fold", *[f"c.x.{k}" for k in FEATURES])
    table: dict[int, list] = {}
    for r in cells.agg(F.count_if("c.hit").alias("p"), F.count_if(~F.col("c.hit")).alias("n")).collect():  # CELLS * FOLDS rows at most
        table.setdefault(r["fold"], []).append((tuple(r[k] for k in FEATURES), r["p"], r["n"]))
    trees, least = cross_fitted({k: sorted(v) for k, v in sorted(table.items())}, precision)

    def chosen(k: str) -> Column:
        if math.isinf(least[k]):
            return F.array().cast("array<struct<kind:string,begin:int,end:int>>")
        free = lambda c: ~c["refuted"] & ~over(c) & (~_overlaps(c, "number") if k == "local" else F.lit(True))
        return named(F.filter(k, lambda c: free(c) & (trees.column(c["x"]) >= least[k])), k)

    base = [named(k, k) for k in KINDS]
    return rows.select("doc_id", F.concat(*base, *[chosen(k) for k in GENERATORS]).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; what overlaps an earlier span ends with it."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        free = s["begin"] >= acc["at"]
        more = F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["begin"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(free, more).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(order, start, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.char_length(text))))
