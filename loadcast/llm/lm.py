"""Language-model scoring with causal self-attention over subword ids.

Texts are lower-cased (A-Z), split into words, and every word becomes the ids of
a public subword tokenizer; an end id closes the text. One attention layer,
written and trained in numpy, predicts each id from the ids before it:

* Ids fall into ``GROUPS * MEMBERS`` classes: the most counted ones are classes of
  their own, the rest share ``TAIL`` classes, apart by whether they begin a word.
* Queries, keys and values come from an embedding of the class, with a learned
  bias by distance. An id attends to the ``SPAN`` symbols before it. Windows score
  ``STEP`` ids each and overlap by ``SPAN - 1`` symbols, so that each id is scored
  exactly once with all of its span; padding in front of a text is masked. With one
  layer the weight of a key depends on two classes and a distance: a batch looks
  its weights up in a table of all pairs of classes, made once for its weights, and
  goes through the span for all its windows at a time.
* The output is a group, a member within it, and the share of the id in its class
  by the counts of all training texts: a proper log probability of the text.

Training takes every training document once. Documents are dealt by a hash of the
row to as many lanes as hold ``LANE_WORDS`` words each; a lane goes through its
documents in the order of that hash, one Adam step a batch, the first ``RAMP`` steps
of ``FIRST`` windows, then twice as many after each ``RAMP`` steps, up to ``BATCH``.
A first round over one eighth of the documents, in lanes as long, gives the common
start of the second over the others; after a round the lanes' weights are averaged by their ids, in
whole numbers, so that scores do not depend on partitions or file layout. Ids are
made once and landed, together with the counts of the words they are made of; the
counts of ids, both rounds and the scoring read them.

The base score is a unigram model of words. Words holding at least 1 / ``HEAD`` of
all training tokens (so at most ``HEAD`` of them) are looked up in a broadcast
table; the others meet their counts in packed buckets by word hash, as many as hold
``BUCKET_WORDS`` words each, and only sums per document come back.

Rows: null text is empty: one token, its end. A null ``doc_id`` counts as the
empty text for the fold, so it is held out. Repeated rows are trained on and
scored each. An empty training set gives a uniform base and the untrained model.
Extra columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.store import cut, land, shuffle_partitions
from loadcast.llm.text import LOWER, UPPER, digest

TOKENIZER = "piece_bpe_32k.model"
FOLDS = 10
HEAD = 65_536
GROUPS = 32
MEMBERS = 32
CLASSES = GROUPS * MEMBERS
TAIL = 64
WIDTH = 16
SPAN = 8
STEP = 64
#: Windows of a step: at first, at most, and steps after which they double.
FIRST = 64
BATCH = 1024
RAMP = 64
#: Windows that go through the attention together, and ids through the output.
BLOCK = 64
PART = 2048
#: Largest logit whose exp, summed and squared, stays in single precision.
SAFE = 40.0
RATE = 0.04
SEED = 20
#: Words of a lane of training, and of a bucket of rare words.
LANE_WORDS = 4_000_000
BUCKET_WORDS = 4_000_000
#: Distinct words a task remembers, their characters, and words it takes at a time.
HELD_WORDS = 500_000
CHUNK_WORDS = 100_000
REMEMBERED_CHARS = 4_000_000

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Hash under which the end of a text is counted as a word.
END_WORD = 0


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; bytes split at just the six white-space characters."""
    return text.translate(_FOLD).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


class Numbered:
    """Words numbered as they come, within a bound that ``full`` tells."""

    def __init__(self):
        self.number: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.chars = 0

    def see(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """The number of each word, and the words that are new, in their order."""
        before = len(self.number)
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        new = list(itertools.islice(reversed(self.number), len(self.number) - before))[::-1]
        self.chars += sum(map(len, new))
        return at, new

    def full(self) -> bool:
        return len(self.number) >= HELD_WORDS or self.chars > REMEMBERED_CHARS


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """The texts of a batch in runs: the first row, the words of all its rows, and
    how many each row has. Some ``CHUNK_WORDS`` words; a text is never split."""
    first, words, sizes = 0, [], []
    for i, text in enumerate(batch.column("text")):
        own = words_of(text.as_py())
        words += own
        sizes.append(len(own))
        if len(words) >= CHUNK_WORDS:
            yield first, words, np.array(sizes)
            first, words, sizes = i + 1, [], []
    if sizes:
        yield first, words, np.array(sizes)


def id_kind(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 65_536 else "<u4")


class Subwords:
    """The tokenizer, loaded once in a Python worker."""

    _loaded: dict[str, Subwords] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.begin, self.end = self.model.get_piece_size(), self.model.bos_id(), self.model.eos_id()
        mark = "\u2581"
        self.begins = np.array([self.model.id_to_piece(i).startswith(mark) for i in range(self.size)])
        self.kind = id_kind(self.size)

    @classmethod
    def load(cls, path: str | None) -> Subwords:
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as packed numbers, so a text's ids are one join of bytes."""
        ids = self.model.encode([w.decode() for w in words], num_threads=1)
        flat = np.fromiter(itertools.chain.from_iterable(ids), self.kind).tobytes()
        ends = list(itertools.accumulate((len(x) * self.kind.itemsize for x in ids), initial=0))
        return [flat[lo:hi] for lo, hi in itertools.pairwise(ends)]


# --- the attention model --------------------------------------------------------

PAD = CLASSES
START = CLASSES + 1
SYMBOLS = CLASSES + 2
_SHAPES = {"E": (SYMBOLS, WIDTH), "Wq": (WIDTH, WIDTH), "Wk": (WIDTH, WIDTH), "Wv": (WIDTH, WIDTH),
           "Wr": (WIDTH, WIDTH), "bias": (SPAN,), "G": (WIDTH, GROUPS), "g0": (GROUPS,),
           "M": (GROUPS, WIDTH, MEMBERS), "m0": (GROUPS, MEMBERS)}


class Lexicon:
    """Class of every id and its share there, from its counts. ``begins``: whether
    the id begins a word."""

    def __init__(self, counts: np.ndarray, begins: np.ndarray):
        n = len(counts)
        rank = np.argsort(-counts, kind="stable")
        own = rank[:CLASSES - TAIL]
        first = np.empty(n, np.int64)
        first[own] = np.arange(len(own))
        for side in (False, True):
            tail = rank[CLASSES - TAIL:][begins[rank[CLASSES - TAIL:]] == side]
            mass = np.cumsum(counts[tail] + 0.1)
            half = TAIL // 2
            if len(tail):
                first[tail] = CLASSES - TAIL + half * side + np.minimum(half - 1, (mass / mass[-1] * half).astype(int))
        weight = counts + 0.1
        total = np.bincount(first, weight, CLASSES)
        starts = np.bincount(first, begins, CLASSES) > 0
        # Neighbours in this order share a group: of one kind and about as frequent.
        order = np.lexsort((-total, starts))
        place = np.empty(CLASSES, np.int64)
        place[order] = np.arange(CLASSES)
        self.cls = place[first]
        total = np.maximum(total[order], 1e-3)
        self.share = np.log(weight / total[self.cls])
        grid = total.reshape(GROUPS, MEMBERS)
        self.groups = np.log(grid.sum(axis=1) / grid.sum()).astype(np.float32)
        self.members = np.log(grid / grid.sum(axis=1, keepdims=True)).astype(np.float32)


def initial(lexicon: Lexicon) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    p = {k: (rng.standard_normal(s) * (0.5 if k == "E" else 1 / math.sqrt(WIDTH))).astype(np.float32) for k, s in _SHAPES.items()}
    p["bias"] = np.zeros(_SHAPES["bias"], np.float32)
    p["G"] *= 0.1
    p["M"] *= 0.1
    p["g0"], p["m0"] = lexicon.groups.copy(), lexicon.members.copy()
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in _SHAPES])


def shaped(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in _SHAPES.items():
        n = int(np.prod(s))
        out[k] = x[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def windows(texts: list[np.ndarray], lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of each window, the ids it scores (-1 past the end), and its text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // STEP)
    # Each text lies in a line of its own: padding, start, ids, padding.
    room = SPAN + counts * STEP
    base = np.cumsum(room) - room
    ids = np.full(int(room.sum()), -1, np.int32)
    every = np.concatenate(texts) if texts else np.zeros(0, int)
    place = np.repeat(base + SPAN, sizes) + np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ids[place] = every
    syms = np.full(len(ids), PAD, np.intp)
    syms[place] = lexicon.cls[every]
    syms[base + SPAN - 1] = START
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = base[owner] + nth * STEP
    return syms[start[:, None] + np.arange(STEP + SPAN - 1)], ids[start[:, None] + SPAN + np.arange(STEP)], owner


class Tables:
    """What the weights say for each class, and for each pair of them."""

    def __init__(self, p: dict):
        self.q, self.k = p["E"] @ p["Wq"] / np.sqrt(p["E"].dtype.type(WIDTH)), p["E"] @ p["Wk"]
        s = self.q @ self.k.T
        if _norm(self.q) * _norm(self.k) > SAFE:
            s -= s.max(axis=1, keepdims=True)
            np.maximum(s, -60, out=s)
        self.pairs = np.exp(s, out=s)
        self.pairs[:, PAD] = 0  # the mask: nothing attends to padding
        self.pairs[PAD] = 1  # places past the end are not scored
        self.pairs = self.pairs.ravel()
        self.v, self.r = np.ascontiguousarray((p["E"] @ p["Wv"]).T), np.ascontiguousarray((p["E"] @ p["Wr"]).T)
        self.near = np.exp(p["bias"])
        # Of each group: weights of the groups, then of its members; biases last.
        groups = np.broadcast_to(np.vstack([p["G"], p["g0"]]), (GROUPS, WIDTH + 1, GROUPS))
        self.heads = np.concatenate([groups, np.concatenate([p["M"], p["m0"][:, None]], axis=1)], axis=2)
        # Inputs of the heads are within -1 and 1.
        self.safe = float(np.abs(self.heads).sum(axis=1).max()) <= SAFE


def _norm(x: np.ndarray) -> float:
    return float(np.sqrt((x * x).sum(axis=1).max()))


def _back(d: int) -> slice:
    """The symbols ``d`` places before those a window starts from."""
    return slice(SPAN - 1 - d, SPAN - 1 - d + STEP)


def _attend(t: Tables, syms: np.ndarray) -> tuple:
    """Outputs, contexts (a row per channel), weights and their sums, values and
    places in the table of pairs, and the symbols. Masked attention of whole windows,
    which lie side by side: a step back in all of them is one step in memory."""
    syms = np.ascontiguousarray(syms.T)
    last = syms[_back(0)]
    row = last * SYMBOLS
    v = t.v.take(syms, axis=1)
    at = np.empty((SPAN, *last.shape), syms.dtype)
    for d in range(SPAN):
        np.add(row, syms[_back(d)], out=at[d])
    w = t.pairs.take(at)
    w *= t.near[:, None, None]
    total = w.sum(axis=0)
    c = np.multiply(v[:, _back(0)], w[0])
    room = np.empty_like(c)
    for d in range(1, SPAN):
        c += np.multiply(v[:, _back(d)], w[d], out=room)
    c /= total
    h = t.r.take(last, axis=1)
    h += c
    return np.tanh(h, out=h), c, w, total, v, at, syms


def _blocks(n: int) -> list[slice]:
    return [slice(lo, min(lo + BLOCK, n)) for lo in range(0, n, BLOCK)]


def _outputs(t: Tables, syms: np.ndarray) -> tuple[np.ndarray, list]:
    """Outputs of all places, block by block, over a row of ones; and what each
    block kept."""
    h = np.ones((WIDTH + 1, len(syms) * STEP), t.v.dtype)
    kept = []
    for block in _blocks(len(syms)):
        out, *rest = _attend(t, syms[block])
        h[:WIDTH, block.start * STEP:block.stop * STEP] = out.reshape(WIDTH, -1)
        kept.append(rest)
    return h, kept


def _by_place(x: np.ndarray) -> np.ndarray:
    """A value per window and place, in the order of ``_outputs``."""
    return np.concatenate([x[block].T.ravel() for block in _blocks(len(x))])


def _targets(lexicon: Lexicon, want: np.ndarray) -> tuple:
    """Places of real ids in the order of their group, members, and the groups
    that are there with where parts of each begin and end."""
    real = np.flatnonzero(want >= 0)
    cls = lexicon.cls[want[real]]
    group = (cls // MEMBERS).astype(np.int8)
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(GROUPS + 1))
    parts = [(g, slice(lo, min(lo + PART, edges[g + 1]))) for g in range(GROUPS) for lo in range(edges[g], edges[g + 1], PART)]
    return real[order], cls[order] % MEMBERS, parts


def _logits(t: Tables, g: int, x: np.ndarray) -> np.ndarray:
    """Of the groups and of the members of ``g``, a column per place; each level
    less its maximum where exp could overflow."""
    z = t.heads[g].T @ x
    if not t.safe:
        z[:GROUPS] -= z[:GROUPS].max(axis=0)
        z[GROUPS:] -= z[GROUPS:].max(axis=0)
    return z


def score_windows(p: dict, lexicon: Lexicon, syms: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log probability of the ids each window scores."""
    t, out = Tables(p), np.zeros(len(syms))
    for lo in range(0, len(syms), BATCH):
        batch = slice(lo, lo + BATCH)
        want = _by_place(ids[batch])
        real, member, parts = _targets(lexicon, want)
        owner = _by_place(np.broadcast_to(np.arange(len(out[batch]))[:, None], ids[batch].shape))
        x = _outputs(t, syms[batch])[0].take(real, axis=1)
        got = lexicon.share[want[real]]
        for g, part in parts:
            z = _logits(t, g, x[:, part])
            own = z[g] + z[GROUPS + member[part], np.arange(z.shape[1])]
            np.exp(z, out=z)
            got[part] += own - np.log(z[:GROUPS].sum(axis=0) * z[GROUPS:].sum(axis=0))
        out[batch] = np.bincount(owner[real], got, len(out[batch]))
    return out


def _class_sums(index: np.ndarray, grads: np.ndarray) -> np.ndarray:
    """A row per class: the columns of ``grads`` summed by their class."""
    index = index.ravel()
    return np.stack([np.bincount(index, g.ravel(), SYMBOLS) for g in grads], axis=1)


def gradient(p: dict, lexicon: Lexicon, syms: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean negative log probability of the classes."""
    t, kind = Tables(p), p["E"].dtype
    h, kept = _outputs(t, syms)
    real, member, parts = _targets(lexicon, _by_place(ids))
    scale = kind.type(1 / max(1, len(real)))
    x = h.take(real, axis=1)
    dx = np.zeros((WIDTH, len(real) + 1), kind)  # the last column: places without an id
    heads = np.zeros_like(t.heads)
    for g, part in parts:
        some = x[:, part]
        z = _logits(t, g, some)
        np.exp(z, out=z)
        for level in (z[:GROUPS], z[GROUPS:]):
            level *= scale / level.sum(axis=0)
        z[g] -= scale
        z[GROUPS + member[part], np.arange(z.shape[1])] -= scale
        heads[g] += some @ z.T
        dx[:, part] = t.heads[g, :WIDTH] @ z
    x = x[:WIDTH]
    dx[:, :-1] *= 1 - x * x
    back = np.full(h.shape[1], len(real))
    back[real] = np.arange(len(real))
    dh = dx.take(back, axis=1)
    g = {"G": heads[:, :WIDTH, :GROUPS].sum(axis=0), "g0": heads[:, WIDTH, :GROUPS].sum(axis=0),
         "M": heads[:, :WIDTH, GROUPS:], "m0": heads[:, WIDTH, GROUPS:], "bias": np.zeros_like(p["bias"])}
    dv, places, slopes, lasts = np.zeros((SYMBOLS, WIDTH)), [], [], []
    for block, (c, w, total, v, at, sym) in zip(_blocks(len(syms)), kept):
        own = dh[:, block.start * STEP:block.stop * STEP].reshape(c.shape)
        w /= total
        mean = np.einsum("ksn,ksn->sn", own, c)
        dvs, room = np.zeros_like(v), np.empty_like(c)
        for d in range(SPAN):
            slope = np.einsum("ksn,ksn->sn", own, v[:, _back(d)])
            dvs[:, _back(d)] += np.multiply(own, w[d], out=room)
            slope -= mean
            w[d] *= slope
        g["bias"] += w.sum(axis=(1, 2))
        places.append(at.ravel())
        slopes.append(w.ravel())
        lasts.append(sym[_back(0)].ravel())
        dv += _class_sums(sym, dvs)
    dr = _class_sums(np.concatenate(lasts), dh)
    ds = np.bincount(np.concatenate(places), np.concatenate(slopes), SYMBOLS * SYMBOLS).astype(kind).reshape(SYMBOLS, SYMBOLS)
    dv, dr = dv.astype(kind), dr.astype(kind)
    dq, dk = ds @ t.k / np.sqrt(kind.type(WIDTH)), ds.T @ t.q
    g["E"] = dq @ p["Wq"].T + dk @ p["Wk"].T + dv @ p["Wv"].T + dr @ p["Wr"].T
    g["Wq"], g["Wk"], g["Wv"], g["Wr"] = (p["E"].T @ d for d in (dq, dk, dv, dr))
    return g


class Trainer:
    """Adam over batches of windows."""

    def __init__(self, p: dict[str, np.ndarray], lexicon: Lexicon):
        self.p, self.lexicon, self.steps, self.seen = {k: x.copy() for k, x in p.items()}, lexicon, 0, 0
        self.rest: tuple = ()
        self.m = {k: np.zeros_like(x) for k, x in p.items()}
        self.v = {k: np.zeros_like(x) for k, x in p.items()}

    def learn(self, texts: list[np.ndarray], last: bool = False) -> None:
        """Steps over the windows of texts; those short of a step wait for more."""
        syms, ids, _ = windows(texts, self.lexicon)
        if self.rest:
            syms, ids = (np.concatenate(x) for x in zip(self.rest, (syms, ids)))
        at = 0
        while at < len(syms):
            n = min(BATCH, FIRST << min(self.steps // RAMP, 20))
            if at + n > len(syms) and not last:
                break
            g = gradient(self.p, self.lexicon, syms[at:at + n], ids[at:at + n])
            at += n
            self.steps += 1
            for k, x in g.items():
                self.m[k] += 0.1 * (x - self.m[k])
                self.v[k] += 0.01 * (x * x - self.v[k])
                up = self.m[k] / (1 - 0.9 ** self.steps) / (np.sqrt(self.v[k] / (1 - 0.99 ** self.steps)) + 1e-8)
                self.p[k] -= np.float32(RATE) * up.astype(np.float32)
        self.rest = syms[at:], ids[at:]
        self.seen += sum(map(len, texts))


# --- counts ---------------------------------------------------------------------

def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, n in zip(batch.column("keys"), batch.column("n")):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), "<i8")) for x in (keys, n)], ["key", "n"])


def _count_ids(size: int, kind: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            every = [np.frombuffer(x.as_py(), kind) for x in batch.column("ids")]
            if every:
                total += np.bincount(np.concatenate(every), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["key", "n"])

    return task


def _train(lexicon, start, kind: str):
    """A trainer per lane; rows come sorted by lane."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, now = None, None
        held: list[np.ndarray] = []
        n = 0

        def done() -> pa.RecordBatch:
            trainer.learn(held, last=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([trainer.seen], pa.int64()),
                 pa.array([flat(trainer.p).tolist()], pa.list_(pa.float64()))], ["lane", "seen", "weights"])

        for batch in batches:
            for lane, ids in zip(batch.column("lane").to_pylist(), batch.column("ids")):
                if lane != now:
                    if trainer:
                        yield done()
                    trainer, now, held, n = Trainer(shaped(start.value), lexicon.value), lane, [], 0
                held.append(np.frombuffer(ids.as_py(), kind))
                n += len(held[-1])
                if n >= 200_000:
                    trainer.learn(held)
                    held, n = [], 0
        if trainer:
            yield done()

    return task


def fit(training: DataFrame, lexicon: Lexicon, n_words: int) -> np.ndarray:
    """The weights after both rounds, from rows (row, ids). One row per weight
    reaches the driver in a round."""
    sc = training.sparkSession.sparkContext
    lex, kind = sc.broadcast(lexicon), id_kind(len(lexicon.cls)).str
    weights = flat(initial(lexicon))
    eighth = F.pmod(F.xxhash64(F.lit(SEED), "row"), F.lit(8))
    for part, share in ((eighth == 0, 1), (eighth != 0, 7)):
        lanes = max(1, -(-n_words * share // (8 * LANE_WORDS)))
        lane = F.pmod(F.xxhash64(F.lit(SEED + 1), "row"), F.lit(lanes)).cast("int")
        dealt = (training.where(part).select(lane.alias("lane"), "row", "ids")
                 .repartitionById(lanes, "lane").sortWithinPartitions("lane", "row"))
        got = dealt.mapInArrow(_train(lex, sc.broadcast(weights), kind), "lane int, seen long, weights array<double>")
        # Whole numbers: their sums are the same in any order.
        whole = F.round(F.col("w") * F.lit(2.0**24)).cast("long") * F.col("seen")
        rows = (got.select("seen", F.posexplode("weights").alias("at", "w")).groupBy("at")
                .agg(F.sum(whole.cast("decimal(38,0)")).alias("w"), F.sum("seen").alias("seen")).collect())
        if rows:
            weights = np.array([float(r.w) / r.seen / 2.0**24 for r in sorted(rows)])
    return weights


# --- scoring --------------------------------------------------------------------

def _encode(path: str | None):
    """The ids of every row; and rows that count the words of the training rows."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = Subwords.load(path)
        end = np.array([sub.end], sub.kind).tobytes()
        schema = None
        words, pieces, seen, texts = Numbered(), [], [], 0

        def counted() -> pa.RecordBatch:
            n = np.bincount(np.concatenate(seen), minlength=len(words.number))
            some = np.flatnonzero(n)
            keys = np.append(word_hashes(list(words.number))[some], END_WORD)
            row = {"keys": keys.astype("<i8").tobytes(), "n": np.append(n[some], texts).astype("<i8").tobytes()}
            return pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in schema], schema=schema)

        for batch in batches:
            kept = [i for i, c in enumerate(batch.schema.names) if c != "text"]
            schema = pa.schema([*map(batch.schema.field, kept), ("ids", pa.binary()), ("keys", pa.binary()), ("n", pa.binary())])
            learn = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            for first, every, sizes in runs(batch):
                at, new = words.see(every)
                pieces += sub.packed(new)
                own = list(map(pieces.__getitem__, at.tolist()))
                stops = np.cumsum(sizes).tolist()
                ids = [b"".join(own[lo:hi]) + end for lo, hi in itertools.pairwise([0, *stops])]
                part = learn[first:first + len(sizes)]
                seen.append(at[np.repeat(part, sizes)])
                texts += int(part.sum())
                none = pa.nulls(len(sizes), pa.binary())
                rows = batch.slice(first, len(sizes))
                yield pa.RecordBatch.from_arrays([*map(rows.column, kept), pa.array(ids, pa.binary()), none, none], schema=schema)
                if words.full():
                    yield counted()
                    words, pieces, seen, texts = Numbered(), [], [], 0
        if texts:
            yield counted()

    return task


def _score(lexicon, weights, kind: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, lex = shaped(weights.value), lexicon.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            held: list[np.ndarray] = []
            first, n = 0, 0

            def flush(upto: int) -> None:
                syms, ids, owner = windows(held, lex)
                scores[first:upto] = np.bincount(owner, score_windows(p, lex, syms, ids), len(held)) / math.log(10)

            for i, ids in enumerate(batch.column("ids")):
                held.append(np.frombuffer(ids.as_py(), kind))
                n += len(held[-1])
                if n >= 200_000:
                    flush(i + 1)
                    held, first, n = [], i + 1, 0
            if held:
                flush(batch.num_rows)
            names = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(scores, pa.float64())], [*names, "score"])

    return task


_PACKED = "bucket int, flush long, idx binary, key binary, doc binary, row binary"


def _rare(head, end: tuple[int, float], buckets: int):
    """Words outside the head, packed by bucket with the documents that hold them;
    and in one bucket the documents themselves: their tokens, and of the head's
    words and the end those known and their base score."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        flush, base = TaskContext.get().partitionId() << 24, head.value
        words, keys, values = Numbered(), np.zeros(0, np.int64), np.zeros(0)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        docs: list[tuple] = []
        n, here = 0, 0

        def send() -> pa.RecordBatch:
            idx, key = (np.concatenate(x) for x in zip(*held))
            bucket = (key.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            names, first = np.unique(bucket[order], return_index=True)
            out = [(b, flush, idx[order[lo:hi]].tobytes(), key[order[lo:hi]].astype("<i8").tobytes(), b"", b"")
                   for b, lo, hi in zip(names.tolist(), first, [*first[1:], len(key)])]
            doc, row, tokens, known, sums = (np.concatenate(x).astype(k) for x, k in zip(zip(*docs), ("<i8", "<i8", "<i8", "<i8", "<f8")))
            out.append((flush % buckets, flush, np.arange(here, dtype="<u4").tobytes(),
                        tokens.tobytes() + known.tobytes() + sums.tobytes(), doc.tobytes(), row.tobytes()))
            kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              [x.split()[0] for x in _PACKED.split(", ")])

        for batch in batches:
            doc, row = batch.column("doc").to_numpy(), batch.column("row").to_numpy()
            for first, every, sizes in runs(batch):
                at, new = words.see(every)
                hashes = word_hashes(new)
                keys = np.append(keys, hashes)
                # 0 for a word outside the head.
                values = np.append(values, np.fromiter((base.get(h, 0.0) for h in hashes.tolist()), np.float64, len(new)))
                value, owner = values[at], np.repeat(np.arange(len(sizes)), sizes)
                other = np.flatnonzero(value == 0)
                held.append(((owner[other] + here).astype("<u4"), keys[at[other]]))
                mine = slice(first, first + len(sizes))
                docs.append((doc[mine], row[mine], sizes + 1, sizes - np.bincount(owner[other], minlength=len(sizes)) + end[0],
                             np.bincount(owner, value, len(sizes)) + end[1]))
                n += len(other) + len(sizes)
                here += len(sizes)
                if words.full():
                    words, keys, values = Numbered(), np.zeros(0, np.int64), np.zeros(0)
                if n >= 1_000_000:
                    yield send()
                    held, docs, n, here, flush = [], [], 0, 0, flush + 1
        if held:
            yield send()

    return task


_MET = "flush long, idx binary, known binary, sums binary, doc binary, row binary"


def _meet(total: float, floor: float):
    """For each flush of a bucket, packed: rare words known, and their sum, of its
    documents. The rows that list a flush's documents pass through."""
    def group(words: pa.Table, counts: pa.Table) -> pa.Table:
        key, c = counts.column("key").to_numpy(), counts.column("n").to_numpy()
        order = np.argsort(key)
        key, value = key[order], np.log10((c[order] + 0.1) / total)
        out = []
        for f, i, k, d, r in zip(*(words.column(c).to_pylist() for c in ("flush", "idx", "key", "doc", "row"))):
            if d:
                out.append((f, i, k, b"", d, r))
                continue
            k = np.frombuffer(k, "<i8")
            at = np.minimum(np.searchsorted(key, k), max(0, len(key) - 1))
            hit = key[at] == k if len(key) else np.zeros(len(k), bool)
            names, back = np.unique(np.frombuffer(i, "<u4"), return_inverse=True)
            sums = np.bincount(back, np.where(hit, value[at] if len(key) else 0.0, floor))
            out.append((f, names.astype("<u4").tobytes(), np.bincount(back, hit).astype("<u4").tobytes(), sums.astype("<f8").tobytes(), b"", b""))
        kinds = (pa.int64(), *[pa.binary()] * 5)
        columns = list(zip(*out)) if out else [[]] * 6
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in _MET.split(", ")])

    return group


def _gather(group: pa.Table) -> pa.Table:
    """Tokens, known ones and base score of the documents of one flush."""
    rows = sorted(zip(*(group.column(c).to_pylist() for c in ("idx", "known", "sums", "doc", "row"))), key=lambda x: (not x[3], x[0], x[2]))
    _, numbers, _, doc, row = rows[0]  # the list of the documents
    tokens, known, base = np.frombuffer(numbers, "<i8").reshape(3, -1).copy()
    base = base.view("<f8")
    for i, n, s, *_ in rows[1:]:
        at = np.frombuffer(i, "<u4")  # an index once in a row
        known[at] += np.frombuffer(n, "<u4")
        base[at] += np.frombuffer(s, "<f8")
    return pa.table({"doc": np.frombuffer(doc, "<i8"), "row": np.frombuffer(row, "<i8"), "tokens": tokens, "known": known, "base": base})


def score_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row of ``docs``. ``tokenizer``: path of a SentencePiece model that
    executors can read; without one the public file is looked up there."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    _, r2 = digest("doc_id", "text")
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc"), F.encode("text", "UTF-8").alias("text"), r2.alias("row"),
                       (F.pmod(F.crc32(F.encode(named, "UTF-8")), F.lit(FOLDS)) == 0).alias("held_out"))
    sub = Subwords.load(tokenizer)
    kind = id_kind(sub.size).str
    doc_kind = rows.schema["doc_id"].dataType.simpleString()
    landed = land(rows.select("doc_id", "row", "held_out", "text").mapInArrow(
        _encode(tokenizer), f"doc_id {doc_kind}, row long, held_out boolean, ids binary, keys binary, n binary"))
    encoded = landed.where("keys is null").select("doc_id", "row", "held_out", "ids")
    training = encoded.where(~F.col("held_out")).select("row", "ids")
    ids = np.zeros(sub.size)
    for r in (training.select("ids").mapInArrow(_count_ids(sub.size, kind), "key long, n long")
              .groupBy("key").agg(F.sum("n").alias("n")).collect()):  # at most a row per id of the tokenizer
        ids[r.key] = r.n
    words = cut(landed.where("keys is not null").select("keys", "n").mapInArrow(_unpack, "key long, n long")
                .groupBy("key").agg(F.sum("n").alias("n")))
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = int(sums["n"] or 0), int(sums["v"])
    total = n + 0.1 * (v + 1)
    floor = math.log10(0.1 / total)
    least = max(1, -(-n // HEAD))
    top = words.where(F.col("n") >= least).collect()  # at most HEAD rows: each holds n / HEAD tokens
    ends = words.where(F.col("key") == END_WORD).agg(F.sum("n")).first()[0] or 0
    end = (int(ends > 0), math.log10((ends + 0.1) / total))
    head = sc.broadcast({r.key: math.log10((r.n + 0.1) / total) for r in top if r.key != END_WORD})
    lexicon = Lexicon(ids, sub.begins)
    weights = sc.broadcast(fit(training, lexicon, n))
    scored = encoded.mapInArrow(_score(sc.broadcast(lexicon), weights, kind),
                                f"doc_id {doc_kind}, row long, held_out boolean, score double")
    buckets = max(shuffle_partitions(spark), -(-n // BUCKET_WORDS))
    packed = rows.select("doc", "row", "text").mapInArrow(_rare(head, end, buckets), _PACKED)
    tail = words.where(F.col("n") < least).withColumn("bucket", _unsigned_mod(F.col("key"), buckets))
    met = packed.groupBy("bucket").cogroup(tail.groupBy("bucket")).applyInArrow(_meet(total, floor), _MET)
    base = (met.groupBy("flush").applyInArrow(_gather, "doc long, row long, tokens long, known long, base double")
            .groupBy(F.col("doc").alias("rd"), F.col("row").alias("rr"))
            .agg(F.max("tokens").alias("n_tokens"), F.max("known").alias("n_known"), F.max("base").alias("base_score")))
    same = (F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)) == F.col("rd")) & (F.col("row") == F.col("rr"))
    return scored.join(base, same, "left").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _unsigned_mod(key, buckets: int):
    """The bucket of a signed 64-bit key read as unsigned, as numpy counts it."""
    wrap = (1 << 64) % buckets
    return F.pmod(F.pmod(key, F.lit(buckets)) + F.when(key < 0, F.lit(wrap)).otherwise(0), F.lit(buckets)).cast("int")
