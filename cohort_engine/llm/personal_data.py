"""Personal data: exact base patterns, and further spans chosen by gradient-boosted candidates.

1. Base: four patterns with their checks, leftmost and non-overlapping for each kind.  Each
   is written so that one scan is linear in the text (possessive runs, and mail addresses
   from their sign outwards).
2. Generators propose further, overlapping candidates with high recall: addresses with spelt
   or bracketed signs, addresses beyond ASCII, dotted and coloned hosts, and every run of
   neighbouring digit groups that could be a card or a telephone number.
3. A candidate becomes format features (groups, digits, separators, checks, shape) and
   context features (words before it that speak for its kind or against it, neighbouring
   characters, how many numbers stand around it).
4. Boosted trees (Spark ML) are fitted on the small labelled table ``LINES``, filled with
   drawn digits and names, and on at most ``CONTEXTS`` base spans of a hash sample of the
   documents, in their own surroundings, as they are and disguised.  A candidate is right if
   it is exactly the marked span, so trees learn which of several overlapping ones to take.
   Isotonic regression calibrates on lines kept aside; each kind's threshold is the least
   calibrated score whose candidates there are right ``PRECISION`` of the time.
5. One pass over all documents: base spans, then candidates that touch none of them and pass
   their threshold, best first, without overlaps among themselves.

Defined results: NULL and empty texts have no spans; repeated rows are searched alike; an
empty table gives an empty result; without a single base span in the sample the labelled
table alone is learned; further columns are ignored.  Counts and digest are of base spans.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.llm.common import prepare, table

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000          # documents searched for base spans to learn from, about
CONTEXTS = 3_000         # base spans learned from at most
PER_TEXT = 4             # of one document at most
FILLS = 12               # times each labelled line is filled with other digits and names
TREES, DEPTH, STEP = 30, 4, 0.2
PRECISION = 0.97
NEAR = 48                # characters of context on either side
BLOCK = 20_000           # candidates scored at once
GROUPS = 8               # digit groups of one candidate at most

Span = tuple[int, int, int]              # kind, start, end

# -- base ---------------------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, from each sign outwards: what stands before a sign never holds another one."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in DOTTED.finditer(text) if all(map(small_part, m.group().split(".")))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m.group())) <= 19 and luhn(d)]
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15] if "+" in text else []
    return sorted(out, key=lambda s: (s[1], s[0]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], x[0])))


# -- candidates ---------------------------------------------------------------------------

SIGN = re.compile(r"[ ]?[\[({<][ ]?(?:at|@|arroba|arobase)[ ]?[\])}>][ ]?|[ ](?:at|AT|arroba|arobase)[ ]|[ ]?@[ ]?")
AFTER = re.compile(r"[\w-]{2,40}(?:(?:\.|[ ]?[\[({<][ ]?(?:dot|punkt|point|punto|\.)[ ]?[\])}>][ ]?|[ ](?:dot|DOT|punkt|point|punto)[ ]|[ ]?\.[ ]?(?=[a-z]{2,4}\b))[\w-]{2,24}){1,4}")
HOST = re.compile(r"(?<![\w.:])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|[ ]?\.[ ]?|\[dot\]|[ ]dot[ ])[0-9]{1,3}){3}(?![\w])|(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}(?![\w:])")
NUMBERS = re.compile(r"(?<!\w)[+(]?[0-9]++(?:[ ()./_\xa0\u2013-]{1,3}[0-9]++)*+")
GROUP = re.compile(r"[0-9]+")


def before_sign(text: str, at: int) -> int:
    start = at
    while start > 0 and at - start < 64 and (text[start - 1].isalnum() or text[start - 1] in "._%+'-"):
        start -= 1
    return start


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of every kind."""
    out: list[Span] = []
    for m in SIGN.finditer(text):
        start, found = before_sign(text, m.start()), AFTER.match(text, m.end())
        if found and start < m.start():
            out.append((0, start, found.end()))
    out += [(1, *m.span()) for m in HOST.finditer(text)]
    for m in NUMBERS.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        if m.end() < len(text) and (text[m.end()].isalnum() or text[m.end()] == "_"):
            groups.pop()                 # the last digits begin a word
        for i, (s, _) in enumerate(groups):
            n = 0
            first = s - 1 if s > m.start() and text[s - 1] in "+(" else s
            first -= first > m.start() and text[first - 1] == "+"
            for a, e in groups[i:i + GROUPS]:
                n += e - a
                if n > 19:
                    break
                if n >= 13 and luhn(digits_of(text[s:e])):      # a number that fails the check is no card
                    out.append((2, s, e))
                if 7 <= n <= 15:
                    out.append((3, first, e))
    return out


CUES = (re.compile(r"(?i)mail|contact|write|reach|schreib|correo|courriel|escrib|kontakt"),
        re.compile(r"(?i)\bip\b|host|server|address|adress|dirección|login|from|ping|serveur"),
        re.compile(r"(?i)card|visa|master|amex|karte|carte|tarjeta|credit|debit|kredit|payment|paid"),
        re.compile(r"(?i)t[ée]l|phone|call|fax|mobil|cell|ring|handy|anruf|appel|llam|móvil|whatsapp|sms|text me"))
AGAINST = re.compile(r"(?i)isbn|version|\bv\.|section|chapter|page|order|invoice|ref|model|serial|date|year|population|total|price|cost|score|id\b|no\.|nr\.|"
                     r"rfc|issue|ticket|figure|table|release|build|part|item|euro|\$|€|£|%|km|pages|tracking|patent|doi")
DATE = re.compile(r"(?:19|20)[0-9]{2}[-./ ][01]?[0-9][-./ ][0-3]?[0-9]|[0-3]?[0-9][-./ ][01]?[0-9][-./ ](?:19|20)[0-9]{2}")
COMMON_ENDS = frozenset("com org net edu gov info io de fr es uk eu ch at it nl us".split())
FEATURES = ("email", "ip", "card", "phone", "chars", "digits", "groups", "least_group", "most_group", "plus", "zeros", "brackets", "dots", "dashes", "spaces",
            "separators", "card_length", "issuer", "small_parts", "spelt_sign", "plain_sign", "common_end", "labels", "own_cue", "other_cue", "against", "near_cue",
            "near_against", "dated", "touches_left", "touches_right", "number_left", "number_right", "numbers_near", "even_groups", "local_size", "known_word")
#: Short words that stand before "at" in ordinary sentences (fixed values).
PLAIN_WORDS = frozenset("look looks looking was is are be been it him her them us me you stay stayed meet met held here there live lives home work arrive arrived aim aimed up on in".split())


def features(text: str, span: Span) -> list[float]:
    kind, s, e = span
    own = text[s:e]
    left, right = text[max(0, s - NEAR):s], text[e:e + NEAR]
    sizes = [len(g) for g in GROUP.findall(own)] or [0]
    digits = digits_of(own)
    near = left[-18:]
    sign = SIGN.search(own) if kind == 0 else None
    labels = re.split(r"\W+(?:dot|punkt|point|punto)?\W*", own[sign.end():]) if sign else []
    local = own[:sign.start()] if sign else ""
    shape = [own.count("."), own.count("-"), own.count(" ")]
    return [*(float(kind == k) for k in range(4)), len(own), len(digits), len(sizes), min(sizes), max(sizes), own[0] == "+", digits.startswith("00"),
            own.count("(") + own.count("["), *shape, len(set(own) & set(" .-/_()")), len(digits) in (15, 16), digits[:1] in tuple("3456"),
            kind == 1 and ":" not in own and all(small_part(g) for g in GROUP.findall(own)), bool(sign and "at" in sign.group().lower()), bool(sign and "@" in sign.group()),
            bool(labels) and labels[-1].lower() in COMMON_ENDS, len(labels), bool(CUES[kind].search(left)), any(c.search(left) for i, c in enumerate(CUES) if i != kind),
            bool(AGAINST.search(left)), bool(CUES[kind].search(near)), bool(AGAINST.search(near)), bool(DATE.search(own)), bool(left) and not left[-1].isspace(),
            bool(right) and (right[0].isalnum() or right[0] in "-/_(:@"), bool(re.search(r"[0-9][ ().,/_:-]{0,3}$", left)), bool(re.match(r"[ ().,/_:-]{0,3}[0-9]", right)),
            len(GROUP.findall(left)) + len(GROUP.findall(right)), len(sizes) > 1 and len(set(sizes[:-1])) == 1, len(local),
            local.lower() in PLAIN_WORDS]


# -- labelled lines -----------------------------------------------------------------------

#: One line each: <kind|shape> is a span to find, all else is not.  # draws a digit, 1 to 9 at ^, a name at *.
LINES = """
call me on <phone|(^##) ###-####> after six
phone <phone|^##-###-####> or write
tel <phone|0# ## ## ## ##> le soir
tél. : <phone|0#.##.##.##.##>
Telefon <phone|0### #######>
Tel.: <phone|0##/#######> abends
móvil <phone|6## ### ###> por la tarde
mobile <phone|07### ######>
ring <phone|0044 ## #### ####> today
fax <phone|0049 ## ########>
text me at <phone|^##.###.####> please
cell <phone|^#########>
our number is <phone|(0##) #### ####>
you can reach us at <phone|^## ### ####>
Handy <phone|01## ########>
whatsapp <phone|+## ###/####-##>
write to <email|* at * dot com> soon
mail <email|*(at)*.org> for help
contact <email|*[at]*[dot]net>
e-mail: <email|* @ *.de>
courriel <email|* arobase * point fr>
correo <email|*.* arroba *.es>
send it to <email|* [at] * . com>
kontakt <email|*(at)* punkt de>
reach me <email|*.*##@* .com> any time
<email|*{at}*{dot}org>
my address is <email|*.* AT * DOT com>
server <ip|^#.##.#.##> . no
host <ip|1##[.]1##[.]##[.]#> went down
login from <ip|^#(.)1##(.)#(.)##>
ping <ip|1## . 1## . # . ##>
from <ip|fe80:##a#:#b##:#c##:####:#d##:####:####> today
address <ip|20##:db8:#a:##b:#c##:####:##ef:#> seen
card <card|4###.####.####.####> exp
visa <card|4###/####/####/####>
Karte <card|5###_####_####_####>
paid with <card|3###.######.#####>
tarjeta <card|4###  ####  ####  ####>
carte <card|4############>
on 20##-0#-1# at 1#:3#:2# it rained
from 1#.0#.20## to 2#.1#.20##
ISBN 978-3-##-######-#
ISBN 978 0 ### ##### #
version 1#.2.3##.4###
release 2.#.1#.##### build ####
order ^##-#######-####### shipped
invoice 20##-000###
population ^ ### ### in 20##
a total of ^## ### ### people
price ^.###.###,## euro
section 3.#.1.4 and 5.2.#.1
at 1# dot # percent
look at *.com for more
was at * dot the end
met at *. com was young
they stayed at *.org events
is at *.net already
he looked at * point of view
coordinates 48.#### 2.####
years 19##-20## and 18##-19##
pages 1##-1## 20##
scores 1# 2# 3# 4# 5# 6# 7# 8#
rows # # # # # # # # # #
numbers 12# 45# 78# 01# 34# 67#
time 12:34:#6:78:#0:12 tape
id 00##########
tracking 9400 #### #### #### #### ##
serial ####-####-####-####
ref. ##########
item 5#######
patent 1,2##,3##
doi 10.####/s#####-0##-####
the table 1.# 2.# 3.# 4.# 5.# 6.#
issue 12(3), 45##-46##
distance 3## ### km
model ###-####
account #### #### #### ####
hash 4##########1########
size 10 000 000 000
rfc 2### 5### 8### 7###
game 3-2 1-0 2-2 4-1 0-0
chapter 1.2.3 figure 4.5.6 part 7.8.9
cost $ 12 3## 4##
ticket ####### closed
""".strip().splitlines()
NAMES = ("anna max lena paul maria jean luc petra john mary karl sofia diego carlos ines heidi omar nina example mailbox sample webpost acme "
         "northwind uni office postmail home shop media").split()
FILLERS = ("the meeting was long and we left early", "und dann kam der nächste Tag", "le reste du texte suit ici", "el resto del texto sigue",
           "a line of plain prose follows", "nothing else to say about it", "", "see below", "thanks in advance")


def fill(shape: str, rnd: random.Random) -> str:
    return "".join(str(rnd.randrange(10)) if c == "#" else str(rnd.randrange(2, 10)) if c == "^" else rnd.choice(NAMES) if c == "*" else c for c in shape)


def with_check_digit(text: str) -> str:
    """The last digit changed so that the Luhn sum is right."""
    last = max(i for i, c in enumerate(text) if c.isdigit())
    return next(t for d in range(10) if luhn(digits_of(t := f"{text[:last]}{d}{text[last + 1:]}")))


def filled_line(line: str, rnd: random.Random) -> tuple[str, Span | None]:
    """A labelled line with drawn contents between filler sentences, and its span."""
    left, right = rnd.choice(FILLERS), rnd.choice(FILLERS)
    m = re.search(r"<(\w+)\|(.*?)>", line)
    if not m:
        return f"{left} {fill(line, rnd)} {right}", None
    own = fill(m[2], rnd)
    own = with_check_digit(own) if m[1] == "card" else own
    start = len(f"{left} {fill(line[:m.start()], rnd)}")
    return f"{left} {line[:m.start()]}{own}{line[m.end():]} {right}", (KINDS.index(m[1]), start, start + len(own))


#: Ways to disguise a base span of each kind.
DISGUISES = ((lambda t: t.replace("@", " at ").replace(".", " dot "), lambda t: t.replace("@", "(at)"), lambda t: t.replace("@", " [at] ").replace(".", "[dot]")),
             (lambda t: t.replace(".", "[.]"), lambda t: t.replace(".", " . ")),
             (lambda t: ".".join(re.findall(".{1,4}", digits_of(t))), lambda t: "/".join(re.findall(".{1,4}", digits_of(t)))),
             (lambda t: t.lstrip("+")[t.find(" ") if " " in t else 0:].strip(), lambda t: "00" + t.lstrip("+")))


def training_rows(contexts: list[tuple[str, int, int, int]]) -> tuple[list[list[float]], list[int], list[int]]:
    """Features, labels and parts (0 to 4; the last is for calibration) of all candidates of the labelled lines and contexts."""
    rnd = random.Random(11)
    lines = [(filled_line(line, rnd), k % 5) for line in LINES for k in range(FILLS)]
    for i, (text, kind, s, e) in enumerate(contexts):
        lines.append(((text, (kind, s, e)), i % 5))
        hidden = DISGUISES[kind][i % len(DISGUISES[kind])](text[s:e])
        lines.append(((text[:s] + hidden + text[e:], (kind, s, s + len(hidden))), i % 5))
    x, y, part = [], [], []
    for (text, span), k in lines:
        for c in candidates(text):
            x.append([float(v) for v in features(text, c)])
            y.append(int(c == span))
            part.append(k)
    return x, y, part


def sample_contexts(docs: DataFrame) -> list[tuple[str, int, int, int]]:
    """At most ``CONTEXTS`` base spans of about ``SAMPLE`` documents, in their surroundings."""
    n = max(1, docs.count())
    drawn = docs.select("text").where(F.pmod(F.xxhash64(F.lit("pii"), "text"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / n)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for t in pdf["text"]:
                for kind, s, e in base_spans(t)[:PER_TEXT] if t else ():
                    a = max(0, s - NEAR)
                    rows.append((t[a:e + NEAR], kind, s - a, e - a))
            yield pd.DataFrame(rows, columns=["text", "kind", "s", "e"])

    rows = drawn.mapInPandas(run, "text string, kind int, s int, e int").distinct()
    return [tuple(r) for r in rows.orderBy(F.xxhash64("text", "s"), "text", "s").limit(CONTEXTS).collect()]


# -- the model ----------------------------------------------------------------------------

class Trees:
    """Boosted trees as flat arrays, the ladder that calibrates them, and each kind's threshold."""

    def __init__(self, model: GBTClassificationModel):
        self.trees = [self.flat(t._call_java("rootNode")) for t in model.trees]
        self.weights = list(model.treeWeights)
        self.ladder, self.thresholds = (np.zeros(1), np.zeros(1)), np.full(len(KINDS), np.inf)

    @staticmethod
    def flat(root) -> np.ndarray:
        """(feature, threshold, left, right, value) of every node; feature -1 is a leaf."""
        rows: list[list[float]] = []

        def add(node) -> int:
            at = len(rows)
            rows.append([-1, 0, at, at, node.prediction()])
            if node.getClass().getSimpleName() == "InternalNode":
                rows[at][:2] = [node.split().featureIndex(), node.split().threshold()]
                rows[at][2] = add(node.leftChild())
                rows[at][3] = add(node.rightChild())
            return at
        add(root)
        return np.array(rows)

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin, rows = np.zeros(len(x)), np.arange(len(x))
        for tree, weight in zip(self.trees, self.weights):
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                feature = tree[at, 0].astype(int)
                left = x[rows, np.maximum(feature, 0)] <= tree[at, 1]
                at = np.where(feature < 0, at, np.where(left, tree[at, 2], tree[at, 3]).astype(int))
            margin += weight * tree[at, 4]
        return 1 / (1 + np.exp(-2 * margin))

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.probability(x), *self.ladder)

    def choose(self, texts: list[str], base: list[list[Span]]) -> list[list[tuple[Span, float]]]:
        """For each text the further spans, best first: past their threshold, off the base and off each other."""
        found = [[c for c in candidates(t) if all(c[2] <= s or e <= c[1] for _, s, e in b)] for t, b in zip(texts, base)]
        every = ((t, c) for t, cs in zip(texts, found) for c in cs)
        scores: list[float] = []
        while block := list(islice(every, BLOCK)):
            scores.extend(self.score(np.array([features(t, c) for t, c in block], float)))
        scores_left = iter(scores)
        out = []
        for cs in found:
            passed = sorted(((p, c) for c, p in zip(cs, islice(scores_left, len(cs))) if p >= self.thresholds[c[0]]), key=lambda r: (-r[0], r[1][1] - r[1][2], r[1]))
            taken: list[tuple[Span, float]] = []
            for p, c in passed:
                if all(c[2] <= s or e <= c[1] for (_, s, e), _ in taken):
                    taken.append((c, float(p)))
            out.append(taken)
        return out


def threshold(score: np.ndarray, right: np.ndarray) -> float:
    """The least score from which on candidates are right ``PRECISION`` of the time (none: infinity)."""
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    last_of_score = np.append(score[order][1:] != score[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero((share >= PRECISION) & last_of_score)
    return float(score[order][good[-1]]) if len(good) else np.inf


def train(docs: DataFrame) -> Trees:
    spark = docs.sparkSession
    x, y, part = training_rows(sample_contexts(docs))
    rows = spark.createDataFrame([(k, v, p) for k, v, p in zip(x, y, part)], "x array<double>, label int, part int").withColumn("features", array_to_vector("x")).persist()
    fitted = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(rows.where("part < 4"))
    kept = fitted.transform(rows.where("part = 4")).select(vector_to_array("probability")[1].alias("p"), F.col("label").cast("double").alias("label"))
    steps = IsotonicRegression(featuresCol="p", labelCol="label").fit(kept)
    rows.unpersist()
    model = Trees(fitted)
    model.ladder = (np.array(steps.boundaries.toArray()), np.array(steps.predictions.toArray()))
    aside = np.array(part) == 4
    xs, ys = np.array(x)[aside], np.array(y)[aside]
    scores = model.score(xs)
    model.thresholds = np.array([threshold(scores[xs[:, k] == 1], ys[xs[:, k] == 1]) for k in range(len(KINDS))])
    return model


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets (overlapping spans as one, by the first one's kind)."""
    out, end = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], x[0])):
        if s >= end:
            out += [text[end:s], f"[{KINDS[kind]}]"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def personal_data(docs: DataFrame, model: Trees | None = None, texts: bool = False) -> DataFrame:
    """Counts, digest and spans of every document; with ``texts`` also the redacted text."""
    model = model or train(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            whole = ["" if t is None else t for t in pdf["text"]]
            base = [base_spans(t) for t in whole]
            more = [[c for c, _ in added] for added in model.choose(whole, base)]
            out = pd.DataFrame({"doc_id": pdf["doc_id"]})
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"] = [sum(s[0] == k for s in b) for b in base]
            out["base_sha256"] = [sha256(written(b).encode()).hexdigest() for b in base]
            out["spans"] = [written(b + m) for b, m in zip(base, more)]
            out["n_added"] = [len(m) for m in more]
            if texts:
                out["redacted"] = [redact(t, b + m) for t, b, m in zip(whole, base, more)]
            yield out

    # ids travel as text: pandas would turn long ones beside a NULL into floats
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        run, f"doc_id string, {counts}, base_sha256 string, spans string, n_added long" + (", redacted string" if texts else ""))
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return personal_data(table(spark, sf_dir, "documents"))
