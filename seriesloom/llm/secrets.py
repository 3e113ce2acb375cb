"""Secret scans: fixed patterns, then character Markov models by log-likelihood ratio.

Two character models (order 2 over 66 symbols) are trained from labelled samples: random
strings, which are the values that the fixed patterns found in a bounded sample of documents
and seeded draws from the usual alphabets, and ordinary identifiers. Those are the sample's
other words that are built of letters, with few digits behind them, and names made of them;
what a first pair of models finds as random as the drawn strings is dropped before the second
is trained, so keys that stand unlabelled in the sample do not count as ordinary. The cut lies
halfway between the 0.999 quantile of held-out identifiers and the 0.02 quantile of held-out
draws. A run of at least `MIN_RUN` key characters outside the fixed spans is a secret if its
mean log-likelihood ratio reaches the cut, or else the part of it between its first and last
piece (cut at "/", "=" and "-") that do. Sampling concerns the models only: every whole text
is scanned.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import pieces, register, table

#: Fixed patterns; kinds in this order.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_RUN = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
PIECE = re.compile(r"[^/=-]+")
#: Letters with few digits behind them, several joined by single signs.
ORDINARY = re.compile(r"[A-Za-z]{3,20}[0-9]{0,4}(?:[_/-]+[A-Za-z]{2,20}[0-9]{0,4})*")
#: Quantiles of held-out identifiers and draws between which the cut lies, and the one of the
#: draws above which a sampled word is taken for a key.
HIGH_ORDINARY, LOW_RANDOM, KEY_LIKE = 0.999, 0.02, 0.05
#: Documents that give the models their labelled strings, at most.
FIT_ROWS = 2_000
#: Identifiers kept from them, at most, and drawn random strings.
FIT_WORDS, FIT_DRAWS = 50_000, 4_000

_SYMBOLS = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_"
_CODE = np.full(128, len(_SYMBOLS), np.int64)  # the last code: start, and any other sign
for _i, _c in enumerate(_SYMBOLS):
    _CODE[ord(_c)] = _i
_N = len(_SYMBOLS) + 1
_ALPHABETS = ("0123456789abcdef", string.ascii_uppercase + string.digits,
              string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
              string.ascii_lowercase + string.digits)


def base_spans(text: str, lower: str | None = None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in code points."""
    out = []
    if ":" in text or "=" in text:
        low = text.lower() if lower is None else lower
        if any(k in low for k in ("passw", "secret", "token", "api")):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram cells of all words, one after another, and the word of each."""
    raw = np.frombuffer("".join(words).encode("ascii", "replace"), np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    code = _CODE[raw & 127]
    word = np.repeat(np.arange(len(words)), size)
    first = np.zeros(len(raw), bool)
    first[(np.cumsum(size) - size)[size > 0]] = True
    one = np.where(first, _N - 1, np.roll(code, 1))
    two = np.where(first | np.roll(first, 1), _N - 1, np.roll(code, 2))
    return (two * _N + one) * _N + code, word


class Model:
    """The log ratio of each trigram between random strings and identifiers, and the cut."""

    def __init__(self, random: list[str], ordinary: list[str]):
        tables = []
        for words in (random, ordinary):
            n = np.bincount(_codes(words)[0], minlength=_N**3).reshape(_N, _N, _N) + 0.0
            one = n.sum(0)  # interpolate with shorter contexts
            zero = one.sum(0)
            p0 = (zero + 0.5) / (zero.sum() + 0.5 * _N)
            p1 = (one + 4 * p0) / (one.sum(1, keepdims=True) + 4)
            tables.append(np.log((n + 4 * p1) / (n.sum(2, keepdims=True) + 4)).ravel())
        self.ratio = (tables[0] - tables[1]).astype(np.float32)
        self.cut = 0.0

    def scores(self, words: list[str]) -> np.ndarray:
        """Mean log ratio per character; 0 for an empty word."""
        if not words:
            return np.zeros(0)
        cells, word = _codes(words)
        total = np.bincount(word, self.ratio[cells], len(words))
        return total / np.maximum([len(w) for w in words], 1)


def draw(count: int, seed: bytes = b"draw") -> list[str]:
    """Seeded random strings over the usual alphabets, 20 to 60 characters."""
    rng = np.random.default_rng(int.from_bytes(hashlib.sha256(seed).digest()[:8], "big"))
    kinds = len(_ALPHABETS) + 1
    out = []
    for k in range(count):
        if k % kinds == kinds - 1:  # the usual form of universal identifiers
            x = "".join(rng.choice(list("0123456789abcdef"), 32))
            out.append("-".join((x[:8], x[8:12], x[12:16], x[16:20], x[20:])))
        else:
            out.append("".join(rng.choice(list(_ALPHABETS[k % kinds]), rng.integers(20, 61))))
    return out


def by_hash(words: set[str]) -> list[str]:
    return sorted(words, key=lambda w: hashlib.md5(w.encode()).digest())


def least_words(words: set[str]) -> list[str]:
    """The FIT_WORDS words of least hash, in its order."""
    return by_hash(words)[:FIT_WORDS]


def sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, secret: values of the fixed patterns, and the least of the other words."""
    found: set[str] = set()
    ordinary: set[str] = set()
    for batch in pieces(batches, "text"):
        for text in batch.column("text").to_pylist():
            taken = base_spans(text)
            found.update(text[a:b].rsplit('"', 1)[-1].rsplit(" ", 1)[-1] for a, _, b in taken)
            clear = re.sub(r"\S*[0-9]\S*", " ", text) if taken else text
            ordinary.update(re.findall(r"[A-Za-z0-9_+/=-]{5,}", clear))
            if len(ordinary) > 4 * FIT_WORDS:
                ordinary = set(least_words(ordinary))
            if len(found) > 4 * FIT_WORDS:
                found = set(least_words(found))
    for words, secret in ((least_words(found), True), (least_words(ordinary), False)):
        yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "secret": pa.array([secret] * len(words), pa.bool_())})


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Train on at most `rows` documents, those of smallest row hash.

    Their texts enter whole; the tasks keep the `FIT_WORDS` words of least hash, so the words do
    not depend on how the rows lie. Without any words the drawn strings alone shape the model, against letters only.
    """
    full = docs.where(F.length("text") > 0).withColumn("__h", F.xxhash64(*docs.columns))
    # First the hashes alone find the sample, so that only its texts travel.
    last = full.select("__h").orderBy("__h").limit(rows).agg(F.max("__h")).first()[0]
    picked = full.where(F.col("__h") <= F.lit(last)).select("text").limit(rows) if last is not None else full.select("text").limit(0)
    found, ordinary = set(), set()
    for row in picked.mapInArrow(sample_words, "word string, secret boolean").toLocalIterator():
        (found if row.secret else ordinary).add(row.word)
    found, words = by_hash(found)[:FIT_WORDS], least_words(ordinary)
    random, unseen = [*found, *draw(FIT_DRAWS)], draw(FIT_DRAWS // 4, b"held out")
    words = [w for w in words if ORDINARY.fullmatch(w)]
    if words:  # keys that look like words go
        first = Model(random, words)
        keys = first.scores(words) >= np.quantile(first.scores(unseen), KEY_LIKE)
        words = [w for w, key in zip(words, keys) if not key]
    words = words or list(string.ascii_lowercase)
    # Identifiers of code and paths, made of the words themselves.
    joined = [sep.join(words[i : i + 3]) for i in range(0, len(words) - 3, 3) for sep in "_/-"]
    camel = ["".join(w.capitalize() for w in words[i : i + 3]) for i in range(0, len(words) - 3, 3)]
    ordinary_all = words + joined + camel
    held, kept = ordinary_all[::4], [w for i, w in enumerate(ordinary_all) if i % 4]
    model = Model(random, kept)
    long = [w for w in held if len(w) >= MIN_RUN]
    high = float(np.quantile(model.scores(long), HIGH_ORDINARY)) if long else 0.0
    low = float(np.quantile(model.scores(unseen), LOW_RANDOM))
    model.cut = max(high, (high + low) / 2, 0.05)
    return model


def spans(text: str, model: Model) -> list[tuple[int, int, int]]:
    """Fixed spans, and what the models call random in the runs outside them."""
    base = base_spans(text)
    runs = [(m.start(), m.end()) for m in RUN.finditer(text)]
    if not runs:
        return base
    if base:
        runs = [r for a, b in runs for r in _outside(a, b, base)]
    good = model.scores([text[a:b] for a, b in runs]) >= model.cut
    found = [r for r, yes in zip(runs, good) if yes]
    cut = [[(m.start(), m.end()) for m in PIECE.finditer(text, a, b)] for (a, b), yes in zip(runs, good) if not yes]
    cut = [own for own in cut if own and (len(own) > 1 or own[0][1] - own[0][0] >= MIN_RUN)]
    if cut:  # the run less the ordinary pieces at its ends
        each = iter((model.scores([text[a:b] for own in cut for a, b in own]) >= model.cut).tolist())
        cores = []
        for own in cut:
            random = [p for p in own if next(each)]
            if random and random[-1][1] - random[0][0] >= MIN_RUN:
                cores.append((random[0][0], random[-1][1]))
        good = model.scores([text[a:b] for a, b in cores]) >= model.cut
        found += [c for c, yes in zip(cores, good) if yes]
    return sorted(base + [(a, 3, b) for a, b in found])


def _outside(a: int, b: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a run that no fixed span covers, of at least MIN_RUN characters."""
    out = []
    for x, _, y in base:
        if y > a and x < b:
            if x - a >= MIN_RUN:
                out.append((a, x))
            a = max(a, y)
    return out + [(a, b)] if b - a >= MIN_RUN else out


def show(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs` plus n_assign, n_access, n_hex, n_markov, base_sha256, spans.

    A null text is empty and has no spans; columns of these names are replaced; rows are
    judged one by one, so repeated rows give repeated results.
    """
    names = ("n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans")
    docs = docs.drop(*names)
    held = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in pieces(batches, text):
            cols: list[list] = [[] for _ in names]
            for t in batch.column(text).to_pylist():
                found = spans(t or "", m)
                base = [x for x in found if x[1] < 3]
                for k in range(4):
                    cols[k].append(sum(x[1] == k for x in found))
                cols[4].append(hashlib.sha256(show(base).encode()).hexdigest())
                cols[5].append(show(found))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [*batch.columns, *(pa.array(c, k) for c, k in zip(cols, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *names])

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
        + [f"{n} long" for n in names[:4]] + [f"{n} string" for n in names[4:]]
    )
    return docs.mapInArrow(run, schema)


def redact(text: str, spans_text: str, mark: str = "[secret]") -> str:
    """`text` with each listed span replaced; overlapping spans are one."""
    out, at = [], 0
    for item in sorted((int(a), int(b)) for _, a, b in (x.split(":") for x in spans_text.split(","))):
        if item[1] <= at:
            continue
        if item[0] >= at:
            out += [text[at : item[0]], mark]
        at = item[1]
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with the secrets in `text` replaced; all rows and columns stay, a null stays null."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            new = []
            for t in batch.column(text).to_pylist():
                found = spans(t or "", held.value)
                new.append(redact(t, show(found)) if found else t)
            yield batch.set_column(at, text, pa.array(new, batch.schema.field(text).type))

    return docs.mapInArrow(run, docs.schema)


@register("op10_secrets")
def op10_secrets(spark, sf_dir):
    """Secrets in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scan(docs, fit(docs))
    return out.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"
    )
