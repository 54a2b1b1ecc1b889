"""Personal data: four exact patterns, and a linear-chain conditional random field that adds spans they don't reach.

The field labels words that hold a digit or an at sign; any other word is outside of every span, so a text falls into
islands of neighbouring candidate words, each a chain of its own between two outer words.  Features are shapes of a word and its
neighbours, its lengths and checks, and the words before it.  Weights are fitted by Adam on the chains' likelihood
(forward-backward) over a small labelled table; chains are decoded by Viterbi in numpy, many of a like length at once.

The patterns are walked so that no text costs more than its length, however long its runs of letters or digits are.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm.common import bound_batches
from siftspark.llm.textkit import settle

BASE = ("email", "ip", "card", "phone")
#: Kinds in the order of the results; the field alone finds secrets.
KINDS = (*BASE, "secret")
LABELS = ["", *(f"{x}-{kind}" for kind in KINDS for x in "BI")]
#: Labelled rows that a model learns from at most, a parameter of ``fit``.
ROWS = 4000
#: Words of all chains that are decoded together, about.
TOGETHER = 1 << 16

SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
#: A match can only begin where a run of digits does.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    value = [int(c) for c in reversed(digits)]
    return (sum(value[::2]) + sum(2 * x - 9 * (x > 4) for x in value[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign to the left as far as the name's characters and the match before allow, and to the right."""
    at, floor = text.find("@"), 0
    while at >= 0:
        domain, go_on = _DOMAIN.match(text, at + 1), at + 1
        if domain:
            start = at
            while start > floor and _LOCAL.match(text, start - 1):
                start -= 1
            if start < at:
                yield start, domain.end()
                floor = go_on = domain.end()
        at = text.find("@", go_on)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's place, start, end) of all matches of the four patterns, in order."""
    if not _HINT.search(text):
        return []
    out = [(0, *x) for x in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups())]
    for m in _DIGITS.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = re.sub("[ -]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


_WORD = re.compile(r"\S+")
_KEY = re.compile(r"^([A-Za-z_.-]{1,40})[=:](?=.)")
_LEFT, _RIGHT = "\"'`<[{|*#%$!~", "\"'`>]}|*#%$!~,;:.?"
#: Characters of a word that its shape and its features look at.
LONG_WORD = 400


def _core(word: str) -> tuple[str, int, int]:
    """(key before the value, start, end) of a word without what surrounds it: quotes, brackets, marks, ``key=``."""
    key = _KEY.match(word)
    start, end = (key.end() if key else 0), len(word)
    while start < end and (word[start] in _LEFT or word[start] == "(" and ")" not in word[start:end]):
        start += 1
    while end > start and (word[end - 1] in _RIGHT or word[end - 1] == ")" and "(" not in word[start:end]):
        end -= 1
    return (key[1].lower() if key else ""), start, end


def _shape(core: str) -> str:
    """Digits as 9, hexadecimal letters as h where the core is hexadecimal, letters as a; runs in one."""
    marks = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]", "a", core[:LONG_WORD]))
    marks = re.sub(r"[^9a@.()+_:/-]", "x", marks)
    return re.sub(r"(.)\1+", r"\1", marks)[:24]


def _bucket(n: int) -> int:
    return n if n < 6 else int(np.searchsorted((8, 10, 13, 16, 17, 20, 24, 32, 33, 40, 41, 64, 65), n, "right")) + 5


def _of_word(core: str) -> list[str]:
    """Features of a word by itself."""
    part = core[:LONG_WORD]
    digits = re.sub("[^0-9]", "", part)
    shape = _shape(part)
    mixed = "9" in shape and "a" in shape
    out = [f"s={shape}" if len(shape) < 12 else "s=long", f"d={_bucket(len(digits))}", f"n={_bucket(len(core))}"]
    if mixed and re.fullmatch("[0-9a-fA-F]+", part):
        out.append(f"hex={_bucket(len(core))}")
    if mixed and re.fullmatch("[0-9A-Za-z_+/=-]+", part):
        out.append(f"opaque={_bucket(len(core))}")
    if 16 <= len(digits) <= 19 and len(digits) + part.count("-") == len(core):
        out.append(f"luhn={luhn(digits)}")
    if re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", part):
        out.append(f"octets={all(int(p) <= 255 for p in part.split('.'))}")
    if re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", part):
        out.append("mail")
    if part[:1] in ("+", "("):
        out.append(f"first={part[0]}")
    return out


def islands(text: str) -> list[list[tuple[int, int, list[str]]]]:
    """Chains of candidate words: (start, end, features) of each."""
    found: list[list[tuple[int, int, list[str]]]] = []
    before, before2, last = "^", "^", False
    for m in _WORD.finditer(text):
        word = m[0]
        if not _HINT.search(word):
            before2, before, last = before, word, False
            continue
        key, start, end = _core(word)
        core = word[start:end]
        if last:
            own = found[-1]
            own[-1][2].append(f"next={_shape(core)[:11]}")
            inside = own[-1][3]
        else:
            found.append([])
            own, inside = found[-1], ""
        words = {x.strip(_LEFT + _RIGHT + "()=").lower()[:20] for x in (key, before, before2)} - {""}
        alone = _of_word(core)
        kind = "opaque" if any(f.startswith("opaque") for f in alone) else "digits" if core.isdigit() else "other"
        features = ["any", *alone, *(f"w={x}" for x in sorted(words)), *(f"{kind}&w={x}" for x in sorted(words)), f"prev={inside}"]
        if key:
            features.append("key")
        own.append((m.start() + start, m.start() + end, features, _shape(core)[:11]))
        before2, before, last = before, word, True
    for own in found:
        own[-1][2].append("next=")
    return [[x[:3] for x in own] for own in found]


class Field:
    """Weights of features and of neighbouring labels."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, steps: np.ndarray):
        self.names, self.weights, self.steps = names, weights, steps

    def emissions(self, chains: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """(scores of the words of all chains by label, words of each chain)."""
        size = np.array([len(c) for c in chains], np.int64)
        ids, count = [], []
        for chain in chains:
            for _, _, features in chain:
                own = [self.names[f] for f in features if f in self.names]
                ids += own
                count.append(len(own))
        total = np.zeros((len(ids) + 1, len(LABELS)))
        np.cumsum(self.weights[ids], axis=0, out=total[1:])
        ends = np.cumsum(count)
        return total[ends] - total[ends - np.array(count)], size

    def decode(self, chains: list[list]) -> list[list[int]]:
        """The best labels of each chain, by Viterbi over many chains at once: those of like length stand in one array."""
        out: list[list[int]] = [[] for _ in chains]
        order, at = sorted(range(len(chains)), key=lambda i: -len(chains[i])), 0
        while at < len(order):
            longest = len(chains[order[at]])
            batch = order[at : at + max(1, TOGETHER // longest)]
            at += len(batch)
            scores, size = self.emissions([chains[i] for i in batch])
            first = np.cumsum(size) - size
            best = scores[first] + self.steps[0]
            back = np.zeros((longest, len(batch), len(LABELS)), np.int8)
            for t in range(1, longest):
                live = int((size > t).sum())  # chains are sorted by length
                ways = best[:live, :, None] + self.steps
                back[t, :live] = ways.argmax(1)
                best[:live] = ways.max(1) + scores[first[:live] + t]
            label = (best + self.steps[:, 0]).argmax(1)
            for k, i in enumerate(batch):
                path = [int(label[k])]
                for t in range(int(size[k]) - 1, 0, -1):
                    path.append(int(back[t, k, path[-1]]))
                out[i] = path[::-1]
        return out


def _spans_of(chain: list, labels: list[int]) -> Iterator[tuple[int, int, int]]:
    """(kind's place, start, end) of the runs of labels; a run that doesn't begin with a beginning begins anyway."""
    now = None
    for (start, end, _), label in zip(chain, labels, strict=True):
        kind = (label - 1) // 2 if label else None
        if now and (kind != now[0] or label % 2):
            yield now
            now = None
        if kind is not None:
            now = (kind, now[1] if now else start, end)
    if now:
        yield now


def spans(text: str, field: Field) -> tuple[list, list]:
    """(base spans, all spans) of a text, each by kind and start; added spans touch no base span."""
    return next(iter(spans_of([text], field)))


def spans_of(texts: list[str], field: Field) -> Iterator[tuple[list, list]]:
    base = [base_spans(t) for t in texts]
    chains, owner = [], []
    for i, t in enumerate(texts):
        if _HINT.search(t):
            own = islands(t)
            chains += own
            owner += [i] * len(own)
    added: list[list] = [[] for _ in texts]
    for i, chain, labels in zip(owner, chains, field.decode(chains), strict=True):
        if any(labels):
            added[i] += [x for x in _spans_of(chain, labels) if _possible(KINDS[x[0]], texts[i][x[1] : x[2]])]
    for known, more in zip(base, added, strict=True):
        taken = _joined(known)
        yield known, sorted(known + [x for x in more if not _touches(x, taken)])


def _possible(kind: str, value: str) -> bool:
    """Whether a value of the field's has the digits that its kind must have."""
    if kind not in ("card", "phone"):
        return len(value) <= LONG_WORD
    digits = re.sub("[^0-9]", "", value)
    return 7 <= len(digits) <= 15 if kind == "phone" else 16 <= len(digits) <= 19 and luhn(digits)


def _joined(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The ranges that spans cover, in order and apart."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(x[1:] for x in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _touches(span: tuple[int, int, int], taken: list[tuple[int, int]]) -> bool:
    at = bisect.bisect_left(taken, (span[2],)) - 1  # the last range that begins before the span's end
    return at >= 0 and taken[at][1] > span[1]


def as_text(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(found))


def _log_sum(ways: np.ndarray, axis: int) -> np.ndarray:
    top = ways.max(axis)
    return top + np.log(np.exp(ways - np.expand_dims(top, axis)).sum(axis))


def _chances(scores: np.ndarray, steps: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-likelihood's normaliser, label chances, chances of neighbouring labels summed) of padded chains, longest first."""
    n, length, k = scores.shape
    live, last = mask.sum(0), mask.sum(1) - 1
    ahead, behind, pairs = scores.copy(), np.zeros_like(scores), np.zeros((k, k))
    ahead[:, 0] += steps[0]
    for t in range(1, length):
        ahead[: live[t], t] += _log_sum(ahead[: live[t], t - 1, :, None] + steps, 1)
    norm = _log_sum(ahead[np.arange(n), last] + steps[:, 0], 1)
    behind[np.arange(n), last] = steps[:, 0]
    for t in range(length - 1, 0, -1):
        ways = steps + (scores[: live[t], t] + behind[: live[t], t])[:, None, :]
        pairs += np.exp(ahead[: live[t], t - 1, :, None] + ways - norm[: live[t], None, None]).sum(0)
        behind[: live[t], t - 1] = _log_sum(ways, 2)
    return norm, np.exp(ahead + behind - norm[:, None, None]) * mask[..., None], pairs


def fit(table: DataFrame, limit: int = ROWS, rounds: int = 100, rate: float = 0.15, decay: float = 2e-3) -> Field:
    """A field learned from a labelled table of texts and spans (kind, start, end): at most ``limit`` rows, chosen by a hash.

    Rows with a null text or null spans are left out; an empty table gives a field that labels nothing."""
    rows = table.where("text is not null and spans is not null").select("text", "spans").orderBy(F.xxhash64("text"), "text").limit(limit).collect()
    chains, gold = [], []
    for row in rows:
        for chain in islands(row["text"]):
            labels = []
            for start, end, _ in chain:
                own = next((s for s in row["spans"] if s["start"] < end and start < s["end"]), None)
                place = 0 if own is None else 1 + 2 * KINDS.index(own["kind"])
                labels.append(place + 1 if own is not None and own["start"] < start and labels and labels[-1] >= place > 0 else place)
            chains.append(chain)
            gold.append(labels)
    seen = Counter(f for chain in chains for _, _, features in chain for f in features)
    names = {f: i for i, f in enumerate(f for f, times in seen.items() if times > 1)}
    k = len(LABELS)
    if not names:
        return Field({}, np.zeros((1, k)), np.where(np.arange(k) == 0, 0.0, -1.0)[None, :].repeat(k, 0))
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    chains, gold = [chains[i] for i in order], [gold[i] for i in order]
    n, length = len(chains), max(map(len, chains))
    mask, want = np.arange(length) < np.array([len(c) for c in chains])[:, None], np.zeros((n, length), np.int64)
    want[mask] = [x for own in gold for x in own]
    words = [[names[f] for f in features if f in names] for chain in chains for _, _, features in chain]
    size = np.array([len(x) for x in words])
    ids = np.array([f for x in words for f in x])
    begin = np.cumsum(size) - size
    by_name = np.argsort(ids, kind="stable")
    holder, first = np.repeat(np.arange(len(words)), size)[by_name], np.searchsorted(ids[by_name], np.arange(len(names)))
    true = np.eye(k)[want] * mask[..., None]
    true_pairs = np.zeros((k, k))
    edges = [(0, want[:, 0]), *((want[:, t - 1][mask[:, t]], want[:, t][mask[:, t]]) for t in range(1, length)), (want[np.arange(n), mask.sum(1) - 1], 0)]
    for a, b in edges:
        np.add.at(true_pairs, (a, b), 1)
    weights, steps, scores = np.zeros((len(names), k)), np.zeros((k, k)), np.zeros((n, length, k))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(steps), np.zeros_like(steps)]
    for r in range(1, rounds + 1):
        scores[mask] = np.add.reduceat(weights[ids], begin)
        norm, chance, pairs = _chances(scores, steps, mask)
        pairs[0] += chance[:, 0].sum(0)
        pairs[:, 0] += chance[np.arange(n), mask.sum(1) - 1].sum(0)
        slope = np.add.reduceat((true - chance)[mask][holder], first)
        for value, gradient, (m, v) in ((weights, slope / n - decay * weights, state[:2]), (steps, (true_pairs - pairs) / n - decay * steps, state[2:])):
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient**2 - v)
            value += rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return Field(names, weights, steps)


def labelled(spark: SparkSession, rows: int = 1000, seed: int = 13) -> DataFrame:
    """The small labelled table (text, spans): made-up words around made-up values, drawn by rule.

    Of each kind there are plain and disturbed values (marks around them, keys before them), and look-alikes without a span: dates,
    prices, versions, order numbers, checksums, card numbers of a wrong check digit, addresses of parts beyond 255."""
    rng = np.random.RandomState(seed)

    def digits(n: int) -> str:
        return "".join(map(str, rng.randint(0, 10, n)))

    def some(*choices):
        return choices[rng.randint(len(choices))]

    def word() -> str:
        return "".join(chr(97 + c) for c in rng.randint(0, 26, rng.randint(2, 9)))

    def hexa(n: int) -> str:
        return "".join(some(*"0123456789abcdef") for _ in range(n))

    def opaque(n: int) -> str:
        return "".join(some(*"ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(n))

    def card(good: bool) -> str:
        body = digits(rng.randint(15, 19))
        last = next(str(d) for d in range(10) if luhn(body + str(d)))
        full = body + (last if good else str((int(last) + rng.randint(1, 10)) % 10))
        return some(full, full, full, "-".join(full[i : i + 4] for i in range(0, len(full), 4)))

    def octets(top: int) -> str:
        return ".".join(str(rng.randint(0, top)) for _ in range(4))

    def phone() -> str:
        area, a, b = digits(3), digits(3), digits(4)
        return some(f"+{rng.randint(1, 99)} ({area}) {a}-{b}", f"({area}) {a}-{b}", f"+{rng.randint(1, 99)} {area} {a} {b}", f"{area}-{a}-{b}", f"+{rng.randint(1, 99)}-{area}-{a}-{b}")

    def decoy() -> str:
        return some(
            f"{rng.randint(1990, 2030)}-{rng.randint(1, 13):02d}-{rng.randint(1, 29):02d}", f"{rng.randint(1, 29)}.{rng.randint(1, 13)}.{rng.randint(1990, 2030)}", f"{rng.randint(0, 24)}:{digits(2)}",
            f"${digits(3)}.{digits(2)}", f"v{rng.randint(0, 9)}.{rng.randint(0, 99)}.{rng.randint(0, 9)}", digits(rng.randint(1, 9)), f"#{digits(6)}", f"order {digits(12)}", card(False), card(False), card(False),
            f"{rng.randint(256, 999)}.{octets(999)}"[:15], f"sha256: {hexa(64)}", f"commit {hexa(40)}", f"commit {hexa(7)}", f"checksum = {hexa(32)}", f"id {hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}",
            f"https://{word()}.example/{digits(4)}", f"@{word()}{digits(2)}", f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}", f"{digits(2)}-{digits(2)}", f"{rng.randint(1, 99)}.", f"{word()}{digits(2)}", hexa(40), opaque(24),
            f"{digits(4)} {digits(4)} {digits(4)}", f"{digits(1)}.{digits(1)}.", f"{digits(3)}%", f"({rng.randint(1900, 2030)})", f"[{digits(2)}]",
            " ".join(digits(rng.randint(1, 6)) for _ in range(rng.randint(2, 9))), " ".join(digits(rng.randint(1, 3)) for _ in range(rng.randint(2, 9))), " ".join(f"{digits(2)}.{digits(2)}" for _ in range(rng.randint(2, 8))),
        )

    def disturbed(value: str) -> str:
        mark = some("***", "%%%", "###", "!!", "$$$")
        return " ".join(x + (mark if rng.rand() < 0.6 else "") for x in value.split(" "))

    table = []
    for _ in range(rows):
        text, found = " ".join(word() for _ in range(rng.randint(0, 6))), []
        for _ in range(rng.randint(1, 4)):
            kind = some("email", "ip", "card", "phone", "phone", "secret", "secret", "", "", "", "")
            lead, tail = "", ""
            if kind == "email":
                value = f"{word()}{some('', '.', '_')}{some(word(), digits(2))}@{word()}{some('', digits(1))}.{some('example.com', 'test', 'co.example')}"
            elif kind == "ip":
                value = octets(256)
            elif kind == "card":
                value = card(True)
            elif kind == "phone":
                value = phone()
                lead = some("", "call ", "tel ", "phone: ") if value[0] == "+" else some("call ", "tel ", "phone: ", "")
                value = disturbed(value) if value[0] == "+" and rng.rand() < 0.3 else value
            elif kind == "secret":
                name = some("token", "secret", "password", "api_key", "apikey", "access_key", "bearer", "auth", "key")
                lead, tail = some((f'{name} = "', '"'), (f"{name}=", ""), (f"{name}: ", ""), (f'{name}="', '"'), (f"{name.upper()} = \"", '"'))
                value = some(hexa(rng.choice([32, 40, 48, 64])), opaque(rng.randint(20, 48)), hexa(40).upper())
                value = value if re.search("[0-9]", value) else value + "7"
            else:
                value = decoy()
            text += " " * bool(text) + lead
            if kind:
                stop = len(text) + len(value)
                while text and value and value[stop - len(text) - 1] in "*%#!$":  # marks behind the value aren't part of it
                    stop -= 1
                found.append((kind, len(text), stop))
            text += value + tail + some("", "", ",", ".", "!!", "###") + " " + " ".join(word() for _ in range(rng.randint(1, 5)))
        table.append((text, found))
    return spark.createDataFrame(table, "text string, spans array<struct<kind: string, start: int, end: int>>")


def find(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: how many base spans of each kind, their digest, and all spans as ``kind:start:end``.

    Places count code points, ends are exclusive.  A null text counts as empty and has no spans (the digest is that of the
    empty text).  Repeated rows are judged each; a null key stays null; other columns aren't read, whatever their names.
    An empty table gives no rows.  Memory is bounded by an Arrow batch, or by the longest text.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            rows = list(spans_of(texts, field))
            counts = [[sum(x[0] == k for x in base) for base, _ in rows] for k in range(len(BASE))]
            digests = [hashlib.sha256(as_text(base).encode()).hexdigest() for base, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array([as_text(x) for _, x in rows], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
            )
            settle()

    return docs.select(F.col(key).cast("long").alias("_k"), F.col(text).cast("string").alias("_t")).mapInArrow(run, SCHEMA)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data by a field learned from the table of ``labelled``; see ``find`` for nulls and odd texts."""
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"), fit(labelled(spark)))
