"""Secret scan: patterns, and a character convolutional network over every other candidate.

One pass over the texts finds the pattern spans and all candidates: runs of 8 or more key
characters, but for those of fewer than 16 that are only words (of one case or capitalised, also
joined by signs).  Candidates that meet a pattern span are labelled findings, the others are
ordinary strings; a network in numpy learns from all of both to tell them apart by their characters and
surroundings.  The distinct ones are dealt to classes of some thousand, each with its share of findings;
in every epoch each class goes on from the same weights, in a task of its own, and the weights are averaged.
Made-up texts of the patterns and of ordinary strings are always part of the lesson, so a table with few or
no findings gets a network too.  Its logits are calibrated on all of the quarter that training did not see,
and the threshold is the largest that keeps the wanted recall there, of the table's findings as of the
made-up ones.  Candidates above it that lie in no pattern span become spans of kind "model", also where a
pattern found a part of them.

All patterns use ASCII only and none can match across a line feed, so a slice of rows is scanned as one
byte string with rows separated by line feeds.
"""

from __future__ import annotations

import itertools
import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.scratch import Scratch, shuffles_dropped, small_batches, written

# Fixed patterns: kind, pattern, smallest length, group that has it
ASSIGN = (rb"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
          rb"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]{24,}"  # maximal runs, so the same spans as [0-9a-f]+ of 24 and more
KINDS = ("assign", "access", "hex", "model")
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{8,}")
WORDS = re.compile(rb"[+/_=-]*(?:[A-Z]?[a-z]+|[A-Z]+)?(?:[+/_=-]+(?:[A-Z]?[a-z]+|[A-Z]+))*[+/_=-]*")
LONG = 16  # words of this length and more are candidates as well: pass phrases

BEFORE, INSIDE, AFTER = 24, 40, 16
WIDTH, EMBED, FILTERS = 5, 8, 16
LENGTH = BEFORE + INSIDE + AFTER

# A class learns in one task: so many candidates, and so many bytes of them
CLASS_ROWS, CLASS_BYTES = 20_000, 16 << 20
HELD = 0.25  # share of the candidates that training does not see
BINS = 256  # calibration adds up the logits of a 256th as one, at their mean

_SPAN = "struct<kind:int,start:long,end:long>"
_FOUND = f"base array<{_SPAN}>, candidates array<struct<start:long,end:long,known:boolean,covered:boolean,window:binary>>"


def _matches(buf: bytes):
    """``(kind, start, end)`` in bytes; a match of a pattern that fails its length is consumed and dropped."""
    for kind, pattern in enumerate((ASSIGN, ACCESS, HEX)):
        for m in re.finditer(pattern, buf):
            if kind == 0 and m.end(2) - m.start(2) < 6 or kind == 1 and m.end() - m.start() < 20:
                continue
            yield kind, m.start(), m.end()


def _candidates(buf: bytes):
    """``(start, end)`` in bytes of the runs that may be a key."""
    for m in CANDIDATE.finditer(buf):
        low, high = m.span()
        if high - low >= LONG or not WORDS.fullmatch(buf, low, high):
            yield low, high


def _labelled(candidates, base):
    """Each candidate with whether it meets a pattern span, and whether one holds it; both lists by position."""
    spans_ = sorted((low, high) for low, _, high in base)
    first = 0
    for low, high in candidates:
        # spans of one kind are disjoint, so at most as many as there are kinds are still open
        while first < len(spans_) and spans_[first][1] <= low:
            first += 1
        known = covered = False
        for s, e in itertools.takewhile(lambda x: x[0] < high, itertools.islice(spans_, first, None)):
            known = known or e > low
            covered = covered or s <= low and high <= e
        yield low, high, known, covered


def _window(buf: bytes, begin: int, end: int, low: int, high: int) -> bytes:
    """A candidate with its surroundings in the text that lies between ``begin`` and ``end``."""
    return (buf[max(begin, low - BEFORE):low].rjust(BEFORE, b"\0") + buf[low:high]
            + buf[high:min(end, high + AFTER)].ljust(AFTER, b"\0"))


def _scan(batches, names):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for at, rows, buf, bounds in textkit.slices(texts):
            # a line feed after each row
            joined = np.insert(buf, bounds[1:], 0x0A)
            starts = bounds + np.arange(rows + 1)
            data = joined.tobytes()
            base = [[] for _ in range(rows)]
            for kind, low, high in _matches(data):
                row = int(np.searchsorted(starts, low, "right")) - 1
                base[row].append((low, kind, high))
            candidates = [[] for _ in range(rows)]
            for low, high in _candidates(data):
                row = int(np.searchsorted(starts, low, "right")) - 1
                candidates[row].append((low, high))
            out_base, out_candidates = [], []
            for row in range(rows):
                begin, end = int(starts[row]), int(starts[row + 1]) - 1
                if not base[row] and not candidates[row]:
                    out_base.append([])
                    out_candidates.append([])
                    continue
                # code points before each byte of the row
                points = np.zeros(end - begin + 1, np.int64)
                np.cumsum((joined[begin:end] & 0xC0) != 0x80, out=points[1:])
                out_base.append([{"kind": k, "start": int(points[s - begin]), "end": int(points[e - begin])}
                                 for s, k, e in sorted(base[row])])
                out_candidates.append([{
                    "start": int(points[s - begin]), "end": int(points[e - begin]), "known": known,
                    "covered": covered, "window": _window(data, begin, end, s, e)}
                    for s, e, known, covered in _labelled(candidates[row], base[row])])
            span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
            cand = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("known", pa.bool_()),
                              ("covered", pa.bool_()), ("window", pa.binary())])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, rows), pa.array(out_base, pa.list_(span)), pa.array(out_candidates, pa.list_(cand))],
                names=["id", "base", "candidates"])


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, its pattern spans, and its candidates with their surroundings.

    A null text is empty, and an empty one has no findings.  Spans count code points, end exclusive.
    """
    given = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(lambda batches: _scan(batches, None), f"id {kind}, {_FOUND}")


# --- the network -------------------------------------------------------------------

def pieces(window: bytes) -> np.ndarray:
    """Character numbers of a candidate: one row per INSIDE characters, with the surroundings."""
    raw = np.frombuffer(window, np.uint8)
    codes = np.where((raw >= 32) & (raw < 127), raw - 31, np.where(raw == 0, 0, 96)).astype(np.uint8)
    before, inside, after = codes[:BEFORE], codes[BEFORE:-AFTER], codes[-AFTER:]
    rows = -(-len(inside) // INSIDE)
    out = np.zeros((rows, LENGTH), np.uint8)
    out[:, :BEFORE], out[:, BEFORE + INSIDE:] = before, after
    for i in range(rows):
        part = inside[i * INSIDE:(i + 1) * INSIDE]
        out[i, BEFORE:BEFORE + len(part)] = part
    return out


@dataclass
class Network:
    weights: dict
    scale: float
    shift: float
    threshold: float

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([_forward(self.weights, codes[i:i + 512])[0] for i in range(0, len(codes), 512)]
                              or [np.zeros(0)])

    def probability(self, windows: list[bytes]) -> np.ndarray:
        """Calibrated probability of each candidate; a long one counts as its likeliest piece."""
        if not windows:
            return np.zeros(0)
        return self.calibrated(self.likeliest([pieces(w) for w in windows]))

    def likeliest(self, parts: list[np.ndarray]) -> np.ndarray:
        """The largest logit among the pieces of each candidate."""
        edges = np.cumsum([0, *(len(p) for p in parts[:-1])])
        return np.maximum.reduceat(self.logits(np.concatenate(parts)), edges)

    def calibrated(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * logit + self.shift)))


def _forward(w, codes):
    x = w["embed"][codes]                                             # n, LENGTH, EMBED
    n, steps = len(codes), LENGTH - WIDTH + 1
    view = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)  # n, steps, EMBED, WIDTH
    cols = view.reshape(n, steps, EMBED * WIDTH)
    act = np.maximum(cols @ w["conv"] + w["bias"], 0)                  # n, steps, FILTERS
    first = act[:, :BEFORE].argmax(axis=1)
    second = act[:, BEFORE:].argmax(axis=1) + BEFORE
    at = np.concatenate([first, second], axis=1)                       # n, 2 * FILTERS
    filters = np.tile(np.arange(FILTERS), 2)
    pooled = act[np.arange(n)[:, None], at, filters]
    return pooled @ w["out"] + w["out_bias"][0], (cols, at, filters, pooled)


def _likeliest_piece(w, part: np.ndarray) -> np.ndarray:
    if len(part) == 1:
        return part[0]
    return part[np.argmax(np.concatenate([_forward(w, part[i:i + 512])[0] for i in range(0, len(part), 512)]))]


def _beginning(rng: np.random.Generator) -> dict:
    """Weights before the first lesson, with the moments of Adam."""
    w = {"embed": rng.normal(0, 0.3, (97, EMBED)), "conv": rng.normal(0, 0.2, (EMBED * WIDTH, FILTERS)),
         "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.2, 2 * FILTERS), "out_bias": np.zeros(1)}
    return {"w": w, "m": {k: np.zeros_like(v) for k, v in w.items()}, "v": {k: np.zeros_like(v) for k, v in w.items()},
            "step": 0}


def _train(state: dict, parts: list[np.ndarray], labels: np.ndarray, epochs: int, rng: np.random.Generator) -> dict:
    """Adam on the cross entropy of each candidate's likeliest piece, both classes weighing the same."""
    w, step = dict(state["w"]), state["step"]
    moments = {k: (state["m"][k].copy(), state["v"][k].copy()) for k in w}
    share = max(labels.mean(), 1e-6), max(1 - labels.mean(), 1e-6)
    weight = np.where(labels > 0, 0.5 / share[0], 0.5 / share[1])
    for _ in range(epochs):
        order = rng.permutation(len(parts))
        for i in range(0, len(order), 128):
            b = order[i:i + 128]
            codes = np.stack([_likeliest_piece(w, parts[j]) for j in b])
            logit, (cols, at, filters, pooled) = _forward(w, codes)
            slope = (1 / (1 + np.exp(-logit)) - labels[b]) * weight[b] / len(b)
            grad = {"out": pooled.T @ slope, "out_bias": np.array([slope.sum()])}
            back = slope[:, None] * w["out"][None, :] * (pooled > 0)   # n, 2 * FILTERS
            rows = np.arange(len(b))[:, None]
            picked = cols[rows, at]                                    # n, 2 * FILTERS, EMBED * WIDTH
            conv = np.zeros_like(w["conv"])
            np.add.at(conv.T, filters, np.einsum("nf,nfk->fk", back, picked))
            bias = np.zeros(FILTERS)
            np.add.at(bias, filters, back.sum(axis=0))
            grad["conv"], grad["bias"] = conv, bias
            into = (back[:, :, None] * w["conv"].T[filters][None]).reshape(len(b), -1, EMBED, WIDTH)
            embed = np.zeros_like(w["embed"])
            for j in range(WIDTH):
                np.add.at(embed, codes[rows, at + j].ravel(), into[:, :, :, j].reshape(-1, EMBED))
            grad["embed"] = embed
            step += 1
            for k, g in grad.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w[k] = w[k] - 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return {"w": w, "m": {k: m for k, (m, _) in moments.items()}, "v": {k: v for k, (_, v) in moments.items()},
            "step": step}


def _held(seed: int, ranks) -> np.ndarray:
    """Whether training does not see the candidates of these ranks (ascending); a rank has the same draw wherever it is asked for."""
    source, at, out = np.random.PCG64(seed), 0, np.zeros(len(ranks), bool)
    draws = np.random.Generator(source)
    for i, rank in enumerate(ranks):
        if rank != at:
            source.advance(int(rank) - at)
        out[i], at = draws.random() < HELD, int(rank) + 1
    return out


def _lesson(state: dict, ranks, windows: list[bytes], labels: np.ndarray, invented: list, total: int, epochs: int,
            seed: int, rng: np.random.Generator) -> dict:
    """Train on the candidates of a class and the made-up ones that are not held out; all classes have ``total``."""
    held = _held(seed, [*ranks, *range(total, total + len(invented))])
    labels = np.concatenate([labels, [float(k) for _, k in invented]])[~held]
    seen = [pieces(w) for w, h in zip([*windows, *(w for w, _ in invented)], held) if not h]
    # half of the examples again without their surroundings, so that the string itself counts too
    bare = [p.copy() for p in seen[::2]]
    for p in bare:
        p[:, :BEFORE], p[:, BEFORE + INSIDE:] = 0, 0
    return _train(state, seen + bare, np.concatenate([labels, labels[::2]]), epochs, rng)


def _averaged(states: list[dict]) -> dict:
    return {"step": max(s["step"] for s in states),
            **{of: {k: np.mean([s[of][k] for s in states], axis=0) for k in states[0][of]} for of in ("w", "m", "v")}}


def made_up(rows: int = 4000, seed: int = 5) -> list[tuple[bytes, bool]]:
    """``(window, known)`` of the candidates in invented texts: what the patterns find, and ordinary strings."""
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    wide = letters + letters.upper() + "0123456789"

    def some(of, low, high):
        return "".join(of[i] for i in rng.integers(0, len(of), int(rng.integers(low, high + 1))))

    def word():
        return some(letters, 2, 9)

    def key():
        return (some("0123456789abcdef", 12, 48), some(wide, 10, 44), some(wide + "+/", 20, 64))[int(rng.integers(3))]

    def assigned():
        name = ("password", "passwd", "secret", "token", "api_key", "apikey")[int(rng.integers(6))]
        name = (name, name.upper(), name.capitalize())[int(rng.integers(3))]
        return name + ("=", ": ", " = ", '": "', "='")[int(rng.integers(5))] + key()

    keys = (assigned, assigned, lambda: "AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 16),
            lambda: some("0123456789abcdef", 24, 64))
    ordinary = (
        lambda: some("123456789", 1, 1) + some("0123456789", 8, 19),
        lambda: f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}",
        lambda: "/".join(word() for _ in range(int(rng.integers(3, 6)))) + str(rng.integers(10)),
        lambda: "-".join(word() for _ in range(int(rng.integers(3, 7)))),
        lambda: word() + word().capitalize() + word().capitalize() + str(rng.integers(100)),
        lambda: "_".join((word(), word(), str(rng.integers(1000)))),
        lambda: f"{word()}-{rng.integers(9)}-{word()}-{rng.integers(99)}")
    out = []
    for i in range(rows):
        of = keys if i % 2 else ordinary
        text = " ".join([*(word() for _ in range(int(rng.integers(6)))), of[i // 2 % len(of)](),
                         *(word() for _ in range(int(rng.integers(4))))]).encode()
        base = [(s, k, e) for k, s, e in _matches(text)]
        out += [(_window(text, 0, len(text), s, e), known)
                for s, e, known, _ in _labelled(list(_candidates(text)), base) if known == bool(i % 2)]
    return out


def _ranked(found: DataFrame, seed: int, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """The distinct candidates by rank, findings first and by hash; and their number and bytes."""
    rows = found.select(F.explode("candidates").alias("c")).select("c.window", "c.known").distinct()
    ordered = scratch.written(rows.withColumn("draw", F.xxhash64(F.lit(seed), "window")).orderBy(
        F.desc("known"), "draw", "window").select("window", "known", F.monotonically_increasing_id().alias("place")),
        "secrets_ordered")
    part = F.shiftright("place", 33).cast("int")  # an id is the number of the partition, and of the row in it
    counted = {r["part"]: (r["n"], r["b"]) for r in ordered.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("window")).alias("b")).collect()}
    sizes = [counted.get(i, (0, 0)) for i in range(max(counted, default=0) + 1)]
    first = list(itertools.accumulate((n for n, _ in sizes), initial=0))
    rank = F.get(F.lit(first), part) + F.col("place").bitwiseAND((1 << 33) - 1)
    return ordered.select("window", "known", rank.alias("rank")), first[-1], sum(b for _, b in sizes)


def _learned(ranked: DataFrame, invented: list, total: int, bytes_: int, epochs: int, seed: int) -> dict:
    """The weights after all epochs, each class of candidates in a task of its own."""
    classes = max(1, -(-total // CLASS_ROWS), min(total, -(-bytes_ // CLASS_BYTES)))
    rng = np.random.default_rng(seed)
    state = _beginning(rng)
    if not total:
        return _lesson(state, [], [], np.zeros(0), invented, 0, epochs, seed, rng)["w"]
    dealt = ranked.withColumn("class", F.pmod("rank", F.lit(classes)).cast("int"))
    dealt = dealt.repartitionById(classes, F.col("class"))  # a class a task, and no task without one
    # with one class there is nothing to average
    for rounds in [range(epochs)] if classes == 1 else [[e] for e in range(epochs)]:
        held = ranked.sparkSession.sparkContext.broadcast((state, invented, rng if classes == 1 else None))

        def learn(batches):
            batches = [b for b in batches if b.num_rows]
            table = pa.Table.from_batches(batches).sort_by("rank") if batches else None
            for number in table.column("class").unique().to_pylist() if batches else ():
                own = table.filter(pa.compute.equal(table.column("class"), number))
                before, invented, draws = held.value
                after = _lesson(before, own.column("rank").to_pylist(), own.column("window").to_pylist(),
                                own.column("known").to_numpy().astype(float), invented, total, len(rounds), seed,
                                draws or np.random.default_rng([seed, number, rounds[0]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([pickle.dumps(after)], pa.binary())], names=["class", "state"])

        with shuffles_dropped(ranked.sparkSession):
            told = dealt.mapInArrow(learn, "class int, state binary").collect()
        state = _averaged([pickle.loads(r["state"]) for r in sorted(told, key=lambda r: r["class"])])
        held.destroy()
    return state["w"]


def fit(found: DataFrame, recall: float = 0.995, epochs: int = 12, seed: int = 5) -> Network:
    """Learn from all labelled findings and all other candidates.

    Three quarters of the distinct ones are learned from, the others set calibration and threshold; what reaches the
    driver are weights per class, counts of logits, and of the held-out findings those below the threshold.  The
    made-up examples join them whatever the table holds, so few findings, none, and an empty table give a
    network as well.  A held-out finding of the table and a made-up one are kept with the same ``recall``.
    """
    scratch = Scratch(found.sparkSession)
    ranked, total, bytes_ = _ranked(found, seed, scratch)
    invented = made_up(seed=seed)
    net = Network(_learned(ranked, invented, total, bytes_, epochs, seed), 1.0, 0.0, 0.5)
    held = found.sparkSession.sparkContext.broadcast(vars(net))

    def judge(batches):
        net = Network(**held.value)
        for batch in batches:
            batch = batch.sort_by("rank")
            apart = _held(seed, batch.column("rank").to_pylist())
            given = [w for w, h in zip(batch.column("window").to_pylist(), apart) if h]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("known").to_numpy(zero_copy_only=False)[apart], pa.bool_()),
                 pa.array(net.likeliest([pieces(w) for w in given]) if given else [], pa.float64())],
                names=["known", "logit"])

    told = "known boolean, logit double"
    bins = ranked.mapInArrow(judge, told).groupBy("known", F.floor(F.col("logit") * BINS).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("logit").alias("sum")).orderBy("known", "bin").collect()
    apart = _held(seed, range(total, total + len(invented)))
    own = net.likeliest([pieces(w) for (w, _), h in zip(invented, apart) if h])
    known = np.array([k for (_, k), h in zip(invented, apart) if h])
    times = np.concatenate([[float(r["n"]) for r in bins], np.ones(len(own))])
    logit = np.concatenate([[r["sum"] / r["n"] for r in bins], own])
    y = np.concatenate([[float(r["known"]) for r in bins], known])
    scale, shift, n, findings_ = 1.0, 0.0, times.sum(), (times * y).sum()
    for _ in range(200):  # Platt scaling by gradient steps, labels softened as usual
        p = 1 / (1 + np.exp(-(scale * logit + shift)))
        err = (p - np.where(y > 0, (findings_ + 1) / (findings_ + 2), 1 / (n - findings_ + 2))) * times / n
        scale, shift = scale - 0.05 * (err * logit).sum(), shift - 0.05 * err.sum()
    net.scale, net.shift = max(scale, 1e-3), shift
    # the largest that keeps the wanted recall of both, also where the network is unsure of it
    lowest = [np.sort(own[known])[int((1 - recall) * known.sum() + 1e-9)]] if known.any() else []
    given = sum(r["n"] for r in bins if r["known"])
    if given:
        below = ranked.filter("known").mapInArrow(judge, told).orderBy("logit").limit(int((1 - recall) * given + 1e-9) + 1)
        lowest.append(below.agg(F.max("logit")).first()[0])
    net.threshold = float(net.calibrated(np.array([min(lowest)]))[0])
    scratch.drop("secrets_ordered")
    return net


def spans(found: DataFrame, net: Network) -> DataFrame:
    """``id, base, spans``: pattern spans, and all spans by start, then kind."""
    kind = found.schema["id"].dataType.simpleString()
    # plain values: executors need no installed package
    held = found.sparkSession.sparkContext.broadcast(vars(net))

    def run(batches):
        net = Network(**held.value)
        for batch in batches:
            base = batch.column(1).to_pylist()
            spans_ = [list(b) for b in base]
            rows, given = [], []
            for i, candidates in enumerate(batch.column(2).to_pylist()):
                for c in candidates:
                    if not c["covered"]:
                        rows.append((i, c["start"], c["end"]))
                        given.append(c["window"])
            likely = net.probability(given) >= net.threshold
            for (i, start, end), yes in zip(rows, likely):
                if yes:
                    spans_[i].append({"kind": 3, "start": start, "end": end})
            span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span),
                 pa.array([sorted(s, key=lambda x: (x["start"], x["kind"])) for s in spans_], span)],
                names=["id", "base", "spans"])

    return found.select("id", "base", "candidates").mapInArrow(
        run, f"id {kind}, base array<{_SPAN}>, spans array<{_SPAN}>")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Scan, learn, and add the network's spans: ``id, base, spans`` per row of ``docs``.

    The findings are written to the shared folder, so the texts are read once.  Null and empty texts have no
    spans, every repeated row has its own, and an empty table gives no rows; other columns are not read.
    """
    found = written(findings(docs, doc_id, text), "secrets")
    return spans(found, fit(found, **options))
