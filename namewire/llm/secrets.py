"""Secrets: rules, and a character convolutional network over every other candidate.

The rules' findings always stay. A candidate is any run of 16 key characters or more that no
rule has found, and of a run that a rule found in part, each longer piece that is left. The
network sees the run and the text around it, and a long run window by window. It is trained on
findings, labelled as secret where a rule found the key. What made the rule match is taken
out of the view: the words of the finding before the key are blanked, and each key is also shown
in base 64. So the network does not learn the rules but what keys look like in their
neighbourhood. What the rules left is no sure example of the other label: what a first network takes for a
secret there is left out for the second. All findings are examples: tasks train on their own share for one
pass, and the mean of their networks goes into the next. Its outputs are calibrated on a fifth held back, and the threshold is the highest
that keeps the wanted recall there, whatever its precision, which is returned.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from namewire.llm.base import stored, table

# fixed values: the rules
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones cannot hide longer ones
KINDS = ["assign", "access", "hex", "model"]
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
BEFORE, BODY, AFTER, STEP = 20, 40, 8, 20
WIDTH = BEFORE + BODY + AFTER
TASK_FINDINGS = 20_000  # a task trains on, about
EPOCHS, BATCH = 6, 64
RECALL = 0.98
SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base array<string>,"
          " label array<int>, start array<int>, stop array<int>, view array<string>")


def base_findings(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the key) of the rules' findings, in order."""
    out = []
    low = text.lower()
    if any(word in low for word in WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def view(text: str, start: int, end: int) -> str:
    """Up to ``BODY`` characters from ``start`` and what surrounds them, padded to a fixed width."""
    end = min(end, start + BODY)
    return text[max(0, start - BEFORE): start].rjust(BEFORE) + text[start:end].ljust(BODY) + text[end: end + AFTER].ljust(AFTER)


def windows(start: int, end: int) -> list[int]:
    """Where views of a run start: every ``STEP`` characters, the last one at the run's end."""
    return [start] if end - start <= BODY else [*range(start, end - BODY, STEP), end - BODY]


def candidates(text: str, base: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, str]]:
    """(label, start, end, view): label 1 for the rules' keys, 0 for what they leave of all runs; a view a window."""
    last = None
    for start, _, end, key in base:
        if end - key >= LEAST and (key, end) != last:
            last = key, end
            for at in windows(key, end):
                seen = view(text, at, end)
                blank = min(BEFORE, at - start) if at == key else 0
                after = seen[BEFORE + BODY:]
                if after[0] in "\"'":
                    after = " " + after[1:]
                yield 1, key, end, seen[: BEFORE - blank] + " " * blank + seen[BEFORE: BEFORE + BODY] + after
    at, reach = 0, -1  # findings that start before a place, and how far they reach
    for m in CANDIDATE.finditer(text):
        low, high = m.span()
        pieces = []
        while at < len(base) and base[at][0] < high:
            pieces.append((max(low, reach), base[at][0]))
            reach = max(reach, base[at][2])
            at += 1
        for start, end in [*pieces, (max(low, reach), high)]:
            if end - start >= LEAST:
                yield from ((0, start, end, view(text, k, end)) for k in windows(start, end))


def in_base64(seen: str) -> str:
    """The same view with a key in base 64, the digest of its own, of any length that a view holds."""
    digest = hashlib.sha256(seen[BEFORE: BEFORE + BODY].encode()).digest()
    length = LEAST + digest[0] % (BODY - LEAST + 1)
    return seen[:BEFORE] + base64.b64encode(digest).decode()[:length].ljust(BODY) + seen[BEFORE + BODY:]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Views with their labels, each key also in base 64."""
    for batch in batches:
        yield batch
        keys = [in_base64(v) for k, v in zip(*(batch.column(c).to_pylist() for c in ("label", "view"))) if k]
        yield pa.RecordBatch.from_arrays([pa.array([1] * len(keys), pa.int32()), pa.array(keys, pa.string())], names=["label", "view"])


def _pass(state: np.ndarray, step: int, seed: int):
    """One pass of a task over its examples; gives their number and the state after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), pa.schema([("label", pa.int32()), ("view", pa.string())]))  # TASK_FINDINGS or so
        if len(rows):
            net = CharNet()
            net.load(state)
            net.epoch(encode(rows.column("view").to_pylist()), rows.column("label").to_numpy().astype(np.float64), step,
                      np.random.Generator(np.random.PCG64(seed)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(rows)]), pa.array([net.state()], pa.list_(pa.float64()))], names=["n", "state"])
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the sums of ``n`` and of ``state``."""
    n, total = 0, None
    for batch in batches:
        for rows, state in zip(batch.column("n").to_pylist(), batch.column("state")):
            state = state.values.to_numpy()
            n, total = n + rows, state if total is None else total + state
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total], pa.list_(pa.float64()))], names=["n", "state"])


def mean_state(passed: DataFrame, tasks: int) -> np.ndarray | None:
    """Mean of the arrays ``state``, each counted ``n`` times; summed as arrays, by about the root of ``tasks`` at a time."""
    weighted = passed.select("n", F.transform("state", lambda x: x * F.col("n")).alias("state"))
    for parts in sorted({max(1, round(tasks ** 0.5)), 1}, reverse=True):
        weighted = weighted.repartition(parts).mapInArrow(_summed, "n long, state array<double>")
    whole = weighted.first()
    return np.array(whole.state) / whole.n if whole else None


def _outputs(net: "CharNet", probability: bool):
    """Raw outputs of the network, or probabilities, beside label and view."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = encode(batch.column("view").to_pylist())
            out = net.probability(codes) if probability else net.logits(codes)
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("view"), pa.array(out)], names=["label", "view", "out"])
    return run


def trained(examples: DataFrame, recall: float = RECALL, per_task: int = TASK_FINDINGS, epochs: int = EPOCHS) -> "CharNet":
    """A network fitted on all rows ``label``, ``view`` but a fifth, chosen by hash, that sets its curve and threshold.

    Each task makes one pass over about ``per_task`` rows; then networks are averaged by their rows, and passed on.
    """
    draw = F.xxhash64("view", "label")
    split = examples.withColumn("draw", draw)
    mine, held = split.where(F.pmod("draw", F.lit(5)) != 0), split.where(F.pmod("draw", F.lit(5)) == 0).select("label", "view")
    tasks = max(1, -(-mine.count() // per_task))
    net, step = CharNet(), 0
    for epoch in range(epochs):
        dealt = mine.repartition(tasks, "draw").sortWithinPartitions("draw", "view", "label").select("label", "view")
        passed = stored(dealt.mapInArrow(_pass(net.state(), step, epoch + 1), "n long, state array<double>"), "nets")
        mean = mean_state(passed, tasks)
        if mean is None:
            break
        net.load(np.round(mean, 10))  # whatever the order of the sums
        step += -(-(passed.agg(F.max("n")).first()[0]) // BATCH)

    outputs = stored(held.mapInArrow(_outputs(net, False), "label int, view string, out double").select("label", "out"), "outputs")
    for _ in range(50):  # each step a sum over all, as in CharNet.train
        line = F.lit(net.slope) * F.col("out") + F.lit(net.shift)
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), line))))
        q, off = p * (1 - p), F.col("label") - p
        sums = outputs.agg(F.sum(F.col("out") * off), F.sum(off), F.sum(q * F.col("out") ** 2), F.sum(q * F.col("out")), F.sum(q)).first()
        if sums[0] is None or net.curve_step(*sums) < 1e-4:
            break
    judged = stored(held.mapInArrow(_outputs(net, True), "label int, view string, out double").select("label", "out"), "judged")
    secret = judged.where("label = 1")
    count = secret.count()
    net.threshold = 1.0
    if count:
        net.threshold = secret.orderBy("out").offset(int((1 - recall) * count)).limit(1).first().out
        taken = judged.where(F.col("out") >= net.threshold)
        net.recall = taken.where("label = 1").count() / count
        net.precision = taken.agg(F.avg(F.col("label").cast("double"))).first()[0]
    return net


def fitted(found: DataFrame, recall: float = RECALL, per_task: int = TASK_FINDINGS) -> "CharNet":
    """The network of the rules' keys against what the rules left: all distinct rows ``label``, ``view``.

    What they left may hold secrets too. So a first network is trained on all, and what it takes for
    a secret is no example of the second.
    """
    examples = stored(found.mapInArrow(_examples, "label int, view string"), "examples")
    net = trained(examples, recall, per_task)
    clear = stored(examples.mapInArrow(_outputs(net, True), "label int, view string, out double").where(
        (F.col("label") == 1) | (F.col("out") < net.threshold)).select("label", "view"), "clear")
    if clear.where("label = 0").count() < 20:
        return net
    return trained(clear, recall, per_task)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 512):
            rows = {name.split()[0]: [] for name in SCHEMA.split(", ")}
            ids = batch.column("doc_id").slice(low, 512)
            for text in batch.column("text").slice(low, 512).to_pylist():
                base = base_findings(text or "")
                found = list(candidates(text or "", base))
                joined = spans_text([f[:3] for f in base])
                kinds = [f[1] for f in base]
                for name, value in (
                    ("n_assign", kinds.count(0)), ("n_access", kinds.count(1)), ("n_hex", kinds.count(2)),
                    ("base_sha256", hashlib.sha256(joined.encode()).hexdigest()),
                    ("base", joined.split(",") if joined else []), ("label", [f[0] for f in found]),
                    ("start", [f[1] for f in found]), ("stop", [f[2] for f in found]), ("view", [f[3] for f in found]),
                ):
                    rows[name].append(value)
            types = {"n": pa.int64(), "base_sha256": pa.string(), "base": pa.list_(pa.string()), "view": pa.list_(pa.string()),
                     "label": pa.list_(pa.int32()), "start": pa.list_(pa.int32()), "stop": pa.list_(pa.int32())}
            names = [n for n in rows if n != "doc_id"]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(rows[n], types.get(n, pa.int64())) for n in names)], names=["doc_id", *names])


def encode(views: list[str]) -> np.ndarray:
    """Codes below 128: ASCII characters, 1 for any other."""
    wide = np.array(views, f"<U{WIDTH}").view("<u4").reshape(len(views), -1)
    return np.where((wide > 0) & (wide < 128), wide, np.where(wide == 0, 32, 1)).astype(np.int64)


class CharNet:
    """Embedding, one convolution, highest and mean response of each filter, one hidden layer."""

    def __init__(self, size: int = 8, filters: int = 24, width: int = 5, hidden: int = 16, seed: int = 5):
        draw = np.random.Generator(np.random.PCG64(seed))
        shape = {"e": (128, size), "k": (width * size, filters), "c": (filters,),
                 "h": (2 * filters, hidden), "d": (hidden,), "o": (hidden,), "b": (1,)}
        self.w = {n: draw.normal(0, (1 / s[0]) ** 0.5 if len(s) > 1 else 0.1, s) for n, s in shape.items()}
        self.w["e"] = draw.normal(0, 0.5, shape["e"])
        self.m, self.v = ({n: np.zeros_like(x) for n, x in self.w.items()} for _ in range(2))
        self.width, self.slope, self.shift, self.threshold = width, 1.0, 0.0, 0.5
        self.recall = self.precision = float("nan")  # on the findings held back

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, tuple]:
        w = self.w
        x = w["e"][codes]
        n = codes.shape[1] - self.width + 1
        patches = np.stack([x[:, k: n + k] for k in range(self.width)], axis=2).reshape(len(codes), n, -1)
        a = np.maximum(patches @ w["k"] + w["c"], 0)
        top = a.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(a, top[:, None], 1)[:, 0], a.mean(axis=1)], axis=1)
        z = np.maximum(pooled @ w["h"] + w["d"], 0)
        return z @ w["o"] + w["b"][0], (patches, a, top, pooled, z)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        out = [self.forward(codes[k: k + 256])[0] for k in range(0, len(codes), 256)]
        return np.concatenate(out or [np.zeros(0)])

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(codes) + self.shift, -30, 30)))

    def state(self) -> np.ndarray:
        """All weights and their two moments, one after the other."""
        return np.concatenate([part[n].ravel() for part in (self.w, self.m, self.v) for n in self.w])

    def load(self, state: np.ndarray) -> None:
        at = 0
        for part in (self.w, self.m, self.v):
            for n, x in part.items():
                part[n] = state[at: at + x.size].reshape(x.shape).copy()
                at += x.size

    def epoch(self, codes: np.ndarray, y: np.ndarray, step: int, draw: np.random.Generator) -> int:
        """One pass of Adam over the examples, after ``step`` steps; returns the steps made so far."""
        mixed = draw.permutation(len(y))
        for low in range(0, len(y), BATCH):
            part = mixed[low: low + BATCH]
            batch = codes[part].copy()
            batch[draw.random(len(part)) < 0.5, :BEFORE] = 32
            step += 1
            for n, g in self._gradients(batch, y[part]).items():
                self.m[n] = 0.9 * self.m[n] + 0.1 * g
                self.v[n] = 0.999 * self.v[n] + 0.001 * g * g
                self.w[n] -= 0.004 * (self.m[n] / (1 - 0.9 ** step)) / (np.sqrt(self.v[n] / (1 - 0.999 ** step)) + 1e-8)
        return step

    def curve_step(self, out_off: float, off: float, q_square: float, q_out: float, q: float) -> float:
        """One step to a logistic curve over the net's output, with a little pull towards slope 1; its size."""
        g = np.array([out_off - (self.slope - 1), off - self.shift])
        change = 0.5 * np.linalg.solve(np.array([[q_square + 1, q_out], [q_out, q + 1]]), g)
        self.slope, self.shift = (np.array([self.slope, self.shift]) + change).tolist()
        return float(np.abs(change).max())

    def _gradients(self, codes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        logit, (patches, a, top, pooled, z) = self.forward(codes)
        dl = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        dz = np.outer(dl, w["o"]) * (z > 0)
        dp = dz @ w["h"].T
        f, n = a.shape[2], a.shape[1]
        da = np.repeat(dp[:, None, f:] / n, n, axis=1)
        np.put_along_axis(da, top[:, None], np.take_along_axis(da, top[:, None], 1) + dp[:, None, :f], 1)
        da *= a > 0
        dx = (da @ w["k"].T).reshape(len(y), n, self.width, -1)
        de = np.zeros_like(w["e"])
        for k in range(self.width):
            np.add.at(de, codes[:, k: n + k], dx[:, :, k])
        return {"e": de, "k": np.tensordot(patches, da, ((0, 1), (0, 1))), "c": da.sum(axis=(0, 1)),
                "h": pooled.T @ dz, "d": dz.sum(axis=0), "o": z.T @ dl, "b": np.array([dl.sum()])}

    @classmethod
    def train(cls, views: list[str], labels: np.ndarray, recall: float = RECALL, epochs: int = EPOCHS, seed: int = 5) -> "CharNet":
        """Fit by Adam on four fifths of the findings, calibrate and set the threshold on the rest."""
        net = cls(seed=seed)
        draw = np.random.Generator(np.random.PCG64(seed))
        order = draw.permutation(len(labels))
        codes, y = encode(views)[order], labels[order].astype(np.float64)
        cut = max(1, len(y) // 5)
        held, held_y, codes, y = codes[:cut], y[:cut], codes[cut:], y[cut:]
        step = 0
        for _ in range(epochs):
            step = net.epoch(codes, y, step, draw)
        logits = net.logits(held)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(net.slope * logits + net.shift, -30, 30)))
            q = p * (1 - p)
            net.curve_step((logits * (held_y - p)).sum(), (held_y - p).sum(), (q * logits ** 2).sum(), (q * logits).sum(), q.sum())
        p = net.probability(held)
        secret = np.sort(p[held_y == 1])
        if len(secret):
            net.threshold = float(secret[int((1 - recall) * len(secret))])
            net.recall = float((secret >= net.threshold).mean())
            net.precision = float(held_y[p >= net.threshold].mean())
        else:
            net.threshold = 1.0
        return net


def _judge(net: CharNet | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, added = [], []
            columns = [batch.column(c).to_pylist() for c in ("base", "label", "start", "stop", "view")]
            flat = [v for labels, views in zip(columns[1], columns[4]) for l, v in zip(labels, views) if not l]
            different, place = np.unique(np.array(flat, f"<U{WIDTH}"), return_inverse=True)
            scores = net.probability(encode(list(different)))[place] if net and flat else np.zeros(len(flat))
            passed = iter(scores >= (net.threshold if net else 2.0))
            for base, labels, starts, stops, _ in zip(*columns):
                # a long run is taken if any of its windows is
                own = sorted({(s, 3, e) for l, s, e in zip(labels, starts, stops) if not l and next(passed)})
                parts = [b.split(":") for b in base]
                both = sorted([(int(s), KINDS.index(k), int(e)) for k, s, e in parts] + own)
                spans.append(spans_text(both))
                added.append(len(own))
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")]
                + [pa.array(spans, pa.string()), pa.array(added, pa.int64()),
                   pa.array([net.recall if net else None] * n, pa.float64()),
                   pa.array([net.precision if net else None] * n, pa.float64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model", "net_recall", "net_precision"])

    return run


def find_secrets(
    documents: DataFrame, per_task: int = TASK_FINDINGS, recall: float = RECALL,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Spans of secrets in every text: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``, ``n_model``,
    and recall and precision of the network on the examples held back (what the first network took for a secret is none of them).

    The network is trained on all different findings, about ``per_task`` of them a task;
    with fewer than 20 of either the rules stand alone. A null text is empty; every row is returned, repeated ones too; an empty
    table gives no row; other columns are not looked at, whatever their names. A very long text or run takes time in
    proportion. Spans count code points and overlap no rule's finding if the network added them.
    """
    plain = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    found = stored(plain.mapInArrow(_find, SCHEMA), "findings")
    each = stored(found.where("size(view) > 0").select("doc_id", F.explode(F.arrays_zip("label", "view")).alias("f")).select(
        F.col("f.label").alias("label"), F.col("f.view").alias("view")).distinct(), "different")
    kinds = each.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    net = fitted(each, recall, per_task) if min(kinds) >= 20 else None
    return found.mapInArrow(
        _judge(net), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long,"
        " net_recall double, net_precision double")


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(table(spark, folder, "documents"))
