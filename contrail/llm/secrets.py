"""Secret scans: rules, and a character convolutional network over every candidate and its context."""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stored

# The rules of the contract. Letters of the names count in either case, ASCII only.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I
)
ASSIGN_LEAST = 6
ACCESS_LEAST, HEX_LEAST = 20, 24
ACCESS = re.compile(rb"AKIA[A-Z0-9]{%d,}" % (ACCESS_LEAST - 4))
HEX = re.compile(rb"[0-9a-f]{%d,}" % HEX_LEAST)
KINDS = ["assign", "access", "hex", "model"]
# What the first rule's names begin with, in lower case; it matches nowhere else.
NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")

# A candidate is a whole run of the characters of the first rule's values: one that is long, or one
# of which as much as that rule needs follows an assignment or a quote.
CHARACTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
CANDIDATE_LEAST = 16
MARKS = (b":", b"=", b'"', b"'")
SHORT = re.compile(rb"""[:="'](?=\x20*["']?([A-Za-z0-9+/_=.-]{%d,%d}))""" % (ASSIGN_LEAST, CANDIDATE_LEAST))
# Of fewer marks in so many characters each is looked up and tried by itself; of more, the pattern goes over the text.
RARE = 64
# 1 for each character of a run, 0 for any other. Eight of them are a block, a byte of bits; of each such byte, how many
# ones it begins and ends with.
IN_RUN = bytes(int(c in CHARACTERS) for c in range(256))
AHEAD = np.array([f"{b:08b}0".index("0") for b in range(256)], np.uint8)
BEHIND = np.array([f"{b:08b}"[::-1].find("0") % 9 for b in range(256)], np.uint8)
LEFT, RIGHT = 24, 8
# So many texts are searched as one, which the processor's caches hold.
AT_ONCE = 256
STRETCH = 1 << 16
# The network sees windows of so many characters, each half over the last; a candidate scores as its best.
WINDOW = 96

# The network learns from all candidates, dealt to groups of about so many of either label; each fits a task.
GROUP = 2000
# The first group is learned alone; from there so many rounds are learned by all groups side by side and averaged.
ROUNDS, AVERAGED_RATE = 2, 0.003
# Scores of what is set aside are counted in steps of so much.
STEP = 0.001
# Share of the labelled secrets set aside that the threshold must catch.
RECALL = 0.99
# Runs are learned in pieces of so many characters, which bounds a group in bytes.
PIECE = 4 * WINDOW

# A labelled finding is also learned in other shapes than the rules', so many of each and so many in all at least.
SHAPES, SHAPES_LEAST = 3, 400
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = [
    DIGITS + LOWER[:6],
    DIGITS + UPPER[:6],
    DIGITS + LOWER,
    DIGITS + UPPER,
    DIGITS + LOWER + UPPER,
    DIGITS + LOWER + UPPER + "+/",
]
SHAPE_LENGTHS = (10, 64)
# A run looks random if so many of its neighbours change between letter and digit, or from lower case to upper.
CHANGES = 0.25
KIND_OF = str.maketrans(DIGITS + LOWER + UPPER, "0" * 10 + "a" * 26 + "A" * 26)
CHANGE = ("0a", "a0", "0A", "A0", "aA")
WORDS = re.compile("[A-Za-z]{2,10}")

FINDING = "struct<start:int,end:int,left:string,value:string,right:string,label:int>"
FOUND = f"doc_id long, base array<struct<kind:int,start:int,end:int>>, findings array<{FINDING}>"


def places(text: bytes, names: tuple[bytes, ...]) -> Iterator[int]:
    """Where any of `names` begins in `text`, in order; those of one stretch of it are held at a time."""
    for begin in range(0, len(text), STRETCH):
        found = []
        for name in names:
            end = begin + STRETCH + len(name) - 1
            at = text.find(name, begin, end)
            while at >= 0:
                found.append(at)
                at = text.find(name, at + 1, end)
        yield from sorted(found)


def scanned(texts: list[str]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int]]]]:
    """(start, kind, end) of the rules' matches and (start, end) of the runs that are candidates, of each text, both in order.

    Each kind is leftmost and non-overlapping. The texts are searched as one, with a byte for each code point: "?" for those
    beyond ASCII, and a line feed between two texts. No match and no run holds either. What the second and third rule
    match is part of a long run, since their characters are, so they are searched there only.
    """
    parts = [text.encode("ascii", "replace") for text in texts]
    joined = b"\n".join([*parts, b""])
    base, end = [], 0
    for start in places(joined.lower(), NAMES):
        if start >= end and (m := ASSIGN.match(joined, start)):
            end = m.end()
            if len(m[2]) >= ASSIGN_LEAST:
                base.append((start, 0, end))
    # A long run holds full blocks, side by side; the first of them stands for it. One alone needs enough on either side.
    inside = joined.translate(IN_RUN) + bytes(1)
    bits = np.concatenate([[0], np.packbits(np.frombuffer(inside, np.uint8)), [0]]).astype(np.uint8)
    before, block, after = bits[:-2], bits[1:-1], bits[2:]
    enough = 8 + BEHIND[before] + AHEAD[after] >= CANDIDATE_LEAST
    firsts = np.flatnonzero((block == 255) & (before < 255) & enough) * 8
    long = [(inside.rfind(0, 0, at) + 1, inside.find(0, at)) for at in firsts.tolist()]
    for start, end in long:
        if end - start >= ACCESS_LEAST and joined.find(b"AKIA", start, end) >= 0:
            base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(joined, start, end)]
        if end - start >= HEX_LEAST:
            base += [(m.start(), 2, m.end()) for m in HEX.finditer(joined, start, end)]
    short, at = set(), 0
    rare = RARE * sum(map(joined.count, MARKS)) < len(joined)
    after = (SHORT.match(joined, mark) for mark in places(joined, MARKS)) if rare else SHORT.finditer(joined)
    for m in filter(None, after):
        start, end = m.span(1)
        while at < len(long) and long[at][1] <= start:
            at += 1
        if at < len(long) and long[at][0] <= start:
            continue
        short.add((inside.rfind(0, 0, start) + 1, end))
    out = [([], []) for _ in texts]
    begins = np.cumsum([0] + [len(part) + 1 for part in parts])
    for i, found in enumerate((sorted(base), sorted([*long, *short]))):
        of = np.searchsorted(begins, np.array([f[0] for f in found], int), "right") - 1
        for text, begin, f in zip(of.tolist(), begins[of].tolist(), found):
            out[text][i].append((f[0] - begin, *f[1:-1], f[-1] - begin))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' matches, in order; each kind leftmost and non-overlapping."""
    return scanned([text])[0][0]


def runs(text: str) -> list[tuple[int, int]]:
    """(start, end) of the runs that are candidates, in order."""
    return scanned([text])[0][1]


def candidates(text: str, base: list[tuple[int, int, int]], all_runs: list[tuple[int, int]] | None = None) -> list[dict]:
    """Every run that may be a secret, with its context and label: 1 if it overlaps a rule's match. `all_runs` are its `runs`.

    Values of the rules' matches are always among them. A run that matches only go beyond is
    the name of an assignment, and none.
    """
    found, at, ends = [], 0, []
    for start, end in runs(text) if all_runs is None else all_runs:
        while at < len(base) and base[at][0] < end:
            ends.append(base[at][2])
            at += 1
        ends = [e for e in ends if e > start]
        if ends and min(ends) > end:
            continue
        found.append(
            {
                "start": start,
                "end": end,
                "left": text[max(0, start - LEFT) : start],
                "value": text[start:end],
                "right": text[end : end + RIGHT],
                "label": int(bool(ends)),
            }
        )
    return found


def lists(rows: list[list], fields: list[tuple[str, pa.DataType]]) -> pa.Array:
    """A list of structs for each row, whose items are tuples or dictionaries with a value for each field."""
    flat = [tuple(item.values()) if isinstance(item, dict) else item for row in rows for item in row]
    columns = zip(*flat) if flat else [()] * len(fields)
    structs = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [name for name, _ in fields])
    return pa.ListArray.from_arrays(np.cumsum([0] + [len(row) for row in rows]).astype(np.int32), structs)


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs` with its base spans and candidates; a null text is an empty one."""
    number, text = pa.int32(), pa.string()
    span = [("kind", number), ("start", number), ("end", number)]
    finding = [("start", number), ("end", number), ("left", text), ("value", text), ("right", text), ("label", number)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            found = [x for i in range(0, len(texts), AT_ONCE) for x in scanned(texts[i : i + AT_ONCE])]
            base = lists([[(k, s, e) for s, k, e in b] for b, _ in found], span)
            others = lists([candidates(x, b, r) if r else [] for x, (b, r) in zip(texts, found)], finding)
            yield pa.RecordBatch.from_arrays([batch.column(0), base, others], ["doc_id", "base", "findings"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(run, FOUND), "secret-findings")


def windows(found: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of candidates with their context, in windows, and how many each has: 0 pads, 1 is anything beyond ASCII."""
    texts = [f"{f['left'].rjust(LEFT, chr(0))}{f['value']}{f['right']}" for f in found]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(codes > 126, 1, np.where(codes < 32, 0, codes - 30)).astype(np.uint8)
    lengths = np.array([len(t) for t in texts], int)
    n = np.maximum(1, -(-(lengths - WINDOW // 2) // (WINDOW // 2)))
    ends = np.repeat(np.cumsum(lengths), n)
    starts = np.repeat(np.cumsum(lengths) - lengths, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * (WINDOW // 2)
    out = sliding_window_view(np.append(codes, np.zeros(WINDOW, np.uint8)), WINDOW)[starts]
    out[np.arange(WINDOW) >= (ends - starts)[:, None]] = 0
    return out, n


@dataclass
class Network:
    """Embedding, one convolution, its maximum over the window, a logistic output, scaled to be calibrated."""

    embedding: np.ndarray  # characters x width
    filters: np.ndarray  # (SPAN * width) x filters
    bias: np.ndarray
    output: np.ndarray
    shift: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 1.0

    SPAN = 5

    @classmethod
    def new(cls, rng: np.random.Generator, width: int = 8, filters: int = 24) -> Network:
        return cls(
            rng.normal(0, 0.5, (97, width)),
            rng.normal(0, 0.2, (cls.SPAN * width, filters)),
            np.zeros(filters),
            rng.normal(0, 0.2, filters),
            np.zeros(1),
        )

    def _hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings of `SPAN` characters from each place, rows x places x (SPAN * width); outputs, rows x filters x places."""
        width = self.embedding.shape[1]
        flat = self.embedding.take(x, 0).reshape(len(x), -1)
        columns = np.ascontiguousarray(sliding_window_view(flat, self.SPAN * width, 1)[:, ::width])
        hidden = self.filters.T @ columns.transpose(0, 2, 1)
        hidden += self.bias[:, None]
        return columns, hidden

    def forward(self, x: np.ndarray):
        columns, hidden = self._hidden(x)
        best = hidden.argmax(2)
        pooled = np.maximum(np.take_along_axis(hidden, best[:, :, None], 2)[:, :, 0], 0)
        return pooled @ self.output + self.shift, pooled, best, columns

    def logits(self, x: np.ndarray) -> np.ndarray:
        pooled = [np.maximum(self._hidden(x[i : i + 64])[1].max(2), 0) for i in range(0, len(x), 64)]
        return np.concatenate(pooled) @ self.output + self.shift if pooled else np.zeros(0)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy, in the order of `parameters`."""
        logits, pooled, best, columns = self.forward(x)
        error = (1 / (1 + np.exp(-logits)) - y) / len(x)
        back = error[:, None] * self.output * (pooled > 0)
        picked = columns[np.arange(len(x))[:, None], best]  # rows x filters x (SPAN * width)
        spread = back[:, :, None] * self.filters.T
        width = self.embedding.shape[1]
        at = sliding_window_view(x.astype(int) * width, self.SPAN, 1)[np.arange(len(x))[:, None], best]
        at = at[..., None] + np.arange(width)
        embedding = np.bincount(at.ravel(), spread.ravel(), self.embedding.size).reshape(self.embedding.shape)
        return [embedding, np.einsum("nf,nfk->kf", back, picked), back.sum(0), pooled.T @ error, error.sum(keepdims=True)]

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.output, self.shift]

    def probability(self, found: list[dict]) -> np.ndarray:
        """Calibrated, of each candidate."""
        if not found:
            return np.zeros(0)
        return 1 / (1 + np.exp(-(self.scale[0] * best_logits(self, found) + self.scale[1])))


def fit(
    x: np.ndarray, y: np.ndarray, rng: np.random.Generator, rounds: int = 12, rate: float = 0.01, net: Network | None = None
) -> Network:
    """Trained by Adam on windows and labels, from `net` if there is one; both labels weigh the same."""
    net = copy.deepcopy(net) or Network.new(rng)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    ones, zeros = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    step = 0
    for _ in range(rounds):
        for _ in range(-(-len(y) // 64)):
            step += 1
            batch = np.concatenate([rng.choice(ones, 32), rng.choice(zeros, 32)])
            for p, g, (m, v) in zip(net.parameters(), net.gradients(x[batch], y[batch]), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def looks_random(value: str) -> bool:
    """Do letters and digits, or lower and upper case, change as often as in a key? Of ASCII characters, as all candidates have."""
    kinds = value.translate(KIND_OF)
    return sum(map(kinds.count, CHANGE)) >= CHANGES * (len(value) - 1)


def reshaped(context: dict, rng: np.random.Generator) -> dict:
    """A secret in another alphabet and length, at times after a name, in the given context."""
    alphabet = ALPHABETS[rng.integers(len(ALPHABETS))]
    value = ""
    while not looks_random(value) or not value:
        value = "".join([alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(*SHAPE_LENGTHS, endpoint=True)).tolist()])
    if rng.random() < 0.4:
        name = "".join(LOWER[i] for i in rng.integers(0, 26, rng.integers(2, 6)).tolist())
        value = name + "_=-."[rng.integers(4)] + value
    elif len(alphabet) == 64 and rng.random() < 0.5:
        value += "=" * rng.integers(1, 3)
    return {"left": context["left"], "value": value, "right": context["right"]}


def named(words: list[str], context: dict, rng: np.random.Generator) -> dict:
    """A name, path, version or date made of words of the corpus and small numbers, in the given context."""
    some = [words[i].lower() for i in rng.integers(0, len(words), rng.integers(2, 6)).tolist()]
    case = rng.integers(4)
    if case == 1:
        some = [w.upper() for w in some]
    elif case == 2:
        some = [some[0]] + [w.capitalize() for w in some[1:]]
    elif case == 3:  # a number with marks
        some = [str(rng.integers(10 ** rng.integers(1, 5))) for _ in some]
    if case != 3 and rng.random() < 0.4:
        some[rng.integers(len(some))] += str(rng.integers(100))
    joint = "" if case == 2 else "_-./"[rng.integers(4)]
    return {"left": context["left"], "value": joint.join(some), "right": context["right"]}


def in_other_shapes(found: list[dict], y: np.ndarray, rng: np.random.Generator) -> tuple[list[dict], np.ndarray]:
    """Candidates, and as many more of both labels: keys of other shapes, and names made of words around.

    The rules' matches have few shapes and stand after few names. A network that sees only these learns the
    rules again; one that sees keys of many alphabets in every context learns what a key looks like.
    """
    n = max(SHAPES * int(y.sum()), SHAPES_LEAST)
    more = [reshaped(found[i], rng) for i in rng.integers(0, len(found), n)]
    words = [w for f, k in zip(found, y) for w in WORDS.findall(f"{f['left']} {f['right']}" if k else f"{f['left']} {f['value']}")]
    names = [named(words, found[i], rng) for i in rng.integers(0, len(found), n)] if words else []
    return found + more + names, np.concatenate([y, np.ones(len(more), y.dtype), np.zeros(len(names), y.dtype)])


def both_ways(found: list[dict], y: np.ndarray) -> tuple[list[dict], np.ndarray]:
    """Candidates with their context and without."""
    return found + [{**f, "left": "", "right": ""} for f in found], np.concatenate([y, y])


def learn(found: list[dict], y: np.ndarray, seed: int = 1, **more) -> Network:
    """A network fitted to the windows of labelled candidates.

    Each is seen without its context too, so that the network learns secrets and not only the names
    before them.
    """
    found, y = both_ways(found, y)
    x, n = windows(found)
    return fit(x, np.repeat(y, n), np.random.default_rng(seed), **more)


def best_logits(net: Network, found: list[dict]) -> np.ndarray:
    """The highest output among each candidate's windows."""
    x, n = windows(found)
    return np.maximum.reduceat(net.logits(x), np.cumsum(n) - n)


def calibrate(net: Network, found: list[dict], y: np.ndarray, recall: float) -> None:
    """`calibrate_counts` on candidates and their labels."""
    calibrate_counts(net, best_logits(net, found), y, np.ones(len(y)), recall)


def calibrate_counts(net: Network, logits: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float) -> None:
    """Scale the output to probabilities (Platt), then take the highest threshold that keeps `recall`.

    Each output and label counts `n` times. The labels are drawn alike often, so a probability orders candidates
    and says nothing of their share in the corpus; the threshold has no floor.
    """
    ones, zeros = n[y == 1].sum(), n[y == 0].sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(a * logits + b)))
        w = n * np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[(w * logits**2).sum(), (w * logits).sum()], [(w * logits).sum(), w.sum()]])
        gradient = np.array([(n * (p - target) * logits).sum(), (n * (p - target)).sum()])
        step = np.linalg.solve(hessian + 1e-3 * np.eye(2), gradient)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    net.scale = (float(max(a, 1e-3)), float(b))
    order = np.argsort(logits[y == 1])
    passed = np.searchsorted(np.cumsum(n[y == 1][order]), int((1 - recall) * ones), side="right")
    # A little lower, since sums of a network differ in the last digits with the rows they are made among.
    least = logits[y == 1][order][passed] - 1e-9
    net.threshold = float(1 / (1 + np.exp(-(net.scale[0] * least + net.scale[1]))))


def pieces(found: DataFrame) -> DataFrame:
    """The distinct (left, value, right, label) of the candidates, those of long runs in pieces that overlap by their context."""
    rows = found.select(F.explode("findings").alias("f")).select("f.*")
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.length("value") - 1, F.lit(PIECE))))
    end = F.col("at") + PIECE
    left = F.when(F.col("at") > 0, F.expr(f"substring(value, at - {LEFT - 1}, {LEFT})")).otherwise(F.col("left"))
    right = F.when(end < F.length("value"), F.expr(f"substring(value, at + {PIECE + 1}, {RIGHT})")).otherwise(F.col("right"))
    value = F.expr(f"substring(value, at + 1, {PIECE})")
    return rows.select(left.alias("left"), value.alias("value"), right.alias("right"), "label").distinct()


def groups(found: DataFrame, size: int = GROUP) -> tuple[DataFrame, int]:
    """Every distinct candidate of `findings` with its `group`, and the number of groups; none where all have the same label.

    A group has about `size` of either label, or all that there are: the scarcer label is dealt to several groups. Candidates
    without a label that look random may be secrets that no rule finds: they are left out, unless there are no others.
    """
    rows = pieces(found).withColumn("order", F.xxhash64("value", "left", "right", "label"))
    doubtful = (F.col("label") == 0) & F.udf(looks_random, "boolean")("value")
    rows = stored(rows.withColumn("doubtful", doubtful), "secret-pieces")
    counts = {(r["label"], r["doubtful"]): r["count"] for r in rows.groupBy("label", "doubtful").count().collect()}
    if (0, False) in counts:
        rows = rows.filter(~F.col("doubtful"))
    ones, zeros = counts.get((1, False), 0), counts.get((0, False), counts.get((0, True), 0))
    if not ones or not zeros:
        return rows, 0
    parts = {1: -(-ones // size), 0: -(-zeros // size)}
    n = max(parts.values())
    mine = F.when(F.col("label") == 1, F.lit(parts[1])).otherwise(F.lit(parts[0])).cast("long")
    first = F.pmod(F.col("order"), mine)
    group = F.explode(F.sequence(first, F.lit(n - 1).cast("long"), mine))
    dealt = rows.drop("doubtful").withColumn("group", group).withColumn("group", F.col("group").cast("int"))
    return stored(dealt, "secret-groups"), n


def each_apart(rows: DataFrame, n: int) -> DataFrame:
    """The `n` groups in a partition each: a hash would put several into one, and few bytes, which take much work, are else merged."""
    return rows.repartitionById(n, F.col("group"))


def halves(group: pd.DataFrame) -> list[tuple[list[dict], np.ndarray]]:
    """(candidates, labels) to learn, and the same of those set aside: every third of either label, in all groups alike."""
    group = group.sort_values(["label", "order", "value", "left", "right"], ascending=[False, True, True, True, True])
    aside = (group.groupby("label").cumcount() % 3 == 2).to_numpy()
    y = group["label"].to_numpy()
    found = group[["left", "value", "right"]].to_dict("records")
    if len(set(y[aside])) < 2:  # of a few, all serve for both
        return [(found, y)] * 2
    return [([found[i] for i in np.flatnonzero(half)], y[half]) for half in (~aside, aside)]


def average(net: Network, rows: DataFrame, n: int, seed: int, turn: int) -> None:
    """One more round over all `n` groups: each goes on from `net` with its own candidates, and `net` becomes their mean."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        own = [seed, turn, int(group["group"].iloc[0])]
        found, y = in_other_shapes(*halves(group)[0], np.random.default_rng(own))
        learned = learn(found, y, own, rounds=1, rate=AVERAGED_RATE, net=net)
        flat = np.concatenate([p.ravel() for p in learned.parameters()])
        return pd.DataFrame({"at": np.arange(len(flat)), "value": flat})

    learned = each_apart(rows, n).groupBy("group").applyInPandas(run, "at int, value double")
    # Summed as decimals, so that the order of the groups makes no difference.
    sums = learned.groupBy("at").agg(F.sum(F.col("value").cast("decimal(28,15)")).cast("double").alias("sum"))
    flat = np.array([r["sum"] for r in sums.orderBy("at").collect()]) / n
    for p in net.parameters():
        p[...], flat = flat[: p.size].reshape(p.shape), flat[p.size :]


def scores_aside(net: Network, rows: DataFrame, n: int, seed: int) -> pd.DataFrame:
    """(label, logit, n) of all that the groups have set aside, in steps of `STEP`: the least of a step stands for it."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, ROUNDS, int(group["group"].iloc[0])])
        found, y = both_ways(*in_other_shapes(*halves(group)[1], rng))
        return pd.DataFrame({"label": y.astype("int32"), "logit": best_logits(net, found)})

    scored = each_apart(rows, n).groupBy("group").applyInPandas(run, "label int, logit double")
    steps = scored.groupBy("label", F.floor(F.col("logit") / STEP).alias("step"))
    return steps.agg(F.min("logit").alias("logit"), F.count(F.lit(1)).alias("n")).orderBy("label", "step").toPandas()


def train(found: DataFrame, size: int = GROUP, recall: float = RECALL, seed: int = 1) -> Network | None:
    """A network trained on all labelled candidates of `findings`; none where all have the same label.

    Every third is set aside to calibrate and to choose the threshold. Both labels are learned, and set aside, in
    other shapes too (`in_other_shapes`), so that a few make a network. The driver learns the first of the `groups`;
    with more than one, the groups then go on side by side in tasks, and the driver sees only the mean of their networks and
    counts of scores.
    """
    rows, n = groups(found, size)
    if not n:
        return None
    mine, others = halves(rows.filter("group = 0").toPandas())
    rng = np.random.default_rng(seed)
    net = learn(*in_other_shapes(*mine, rng), seed)
    if n == 1:
        calibrate(net, *both_ways(*in_other_shapes(*others, rng)), recall)
        return net
    for turn in range(ROUNDS):
        average(net, rows, n, seed, turn)
    scores = scores_aside(net, rows, n, seed)
    calibrate_counts(net, scores["logit"].to_numpy(), scores["label"].to_numpy(), scores["n"].to_numpy(), recall)
    return net


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: (doc_id, spans), spans an array of (kind, start, end, score) in order.

    The rules' matches stay as they are, with score 1. The network adds candidates without one whose
    probability reaches its threshold. Where no candidate has a label, or all have one, it adds nothing. Texts are read
    once, whole; an empty or null one has no span, and repeated rows are scanned each.
    """
    found = findings(docs, id_col, text_col)
    net = train(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, others = batch.column(1), batch.column(2)
            row = [np.repeat(np.arange(len(batch)), x.value_lengths().to_numpy()) for x in (base, others)]
            kinds, starts, ends = (x.to_numpy() for x in base.flatten().flatten())
            spans = [(row[0], starts, kinds, ends, np.ones(len(starts)))]
            if net:
                all_ = pa.RecordBatch.from_struct_array(others.flatten())
                open_ = np.flatnonzero(all_["label"].to_numpy() == 0)
                some = all_.take(pa.array(open_))
                scores = net.probability(some.select(["left", "value", "right"]).to_pylist())
                more = (row[1][open_], some["start"].to_numpy(), np.full(len(open_), 3, np.int32), some["end"].to_numpy(), scores)
                spans.append([x[scores >= net.threshold] for x in more])
            row, starts, kinds, ends, scores = (np.concatenate(x) for x in zip(*spans))
            order = np.lexsort((scores, ends, kinds, starts, row))
            kind = pa.array(KINDS).take(pa.array(kinds[order]))
            columns = [kind, *(pa.array(x[order]) for x in (starts, ends, scores))]
            at = np.searchsorted(row[order], np.arange(len(batch) + 1)).astype(np.int32)
            out = pa.ListArray.from_arrays(at, pa.StructArray.from_arrays(columns, ["kind", "start", "end", "score"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["doc_id", "spans"])

    return found.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>")


def op10(docs: DataFrame) -> DataFrame:
    """The query's columns, for every document."""
    text = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.kind <> 'model')"
    counts = [F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return scan(docs).select(
        "doc_id",
        *counts,
        F.sha2(F.expr(text.format(base)), 256).alias("base_sha256"),
        F.expr(text.format("spans")).alias("spans"),
    )


def digest(spans: list[tuple[int, int, int]]) -> str:
    """`base_sha256` of the rules' matches."""
    return sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
