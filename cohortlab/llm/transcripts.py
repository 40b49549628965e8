"""Transcript parsing: a hidden Markov model recovers who speaks.

The units of a transcript (lines, or turns) have a conversation, a sequence
number and a text. A hidden Markov model has one state per role; a unit is
observed by categorical features of its text: the speaker marker at its start
("User:", "### Assistant", "<|system|>", ...), how many lines and words it
has, whether it asks, how it begins. Probabilities are smoothed counts over
all labelled units. The Viterbi path gives each unit's role, and each unit is
rendered in one canonical form without its own marker.

Hot conversations. Units are range-partitioned by (conversation, sequence), so
a conversation of any length spans many blocks. Viterbi is a product of
max-plus matrices: each block gives, for the conversations at its edges, the
best score from every role before the block to every role at its end; these
few matrices are combined per conversation (one small row per block), which
fixes the roles at the block's borders; then every block decodes on its own.
The result is the path of the undivided conversation.

Defined results: units order by (sequence, text, label), nulls last; units
that are equal in conversation, sequence, text and label are one unit for the
model and come out as often as they came in; a null text is an empty one; a null
conversation is a conversation of its own; ties go to the role that sorts
first; without labelled units every role is null; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

#: Words that name a speaker, by the role they stand for (fixed values).
MARKERS = {"user": ("user", "human", "question", "q", "customer", "prompt"),
           "assistant": ("assistant", "ai", "bot", "answer", "a", "model", "response"),
           "system": ("system", "instruction", "instructions", "context")}
SMOOTHING = 0.5
#: Weight, in units, of the belief that a marker names its own role.
MARKER_BELIEF = 20.0
_ROLE_OF = {w: role for role, words in MARKERS.items() for w in words}
_MARKER = re.compile(r"\s*(?:<\|\s*(\w+)\s*\|>|\[\s*(\w+)\s*\]|#{1,6}\s*(\w+)\s*:?(?=\s|$)|\**(\w+)\**\s*:)\s*", re.ASCII)
FEATURES = ("marker", "lines", "words", "asks", "opens")


def marker(text: str) -> tuple[str, int]:
    """(role that the unit's marker names or "", where its text begins)."""
    m = _MARKER.match(text)
    word = next((g for g in m.groups() if g), "").lower() if m else ""
    return (_ROLE_OF[word], m.end()) if word in _ROLE_OF else ("", 0)


def observe(text: str | None) -> tuple[str, ...]:
    """The categorical features of a unit's text."""
    t = text or ""
    role, at = marker(t)
    body = t[at:].strip()
    words = len(body.split())
    return (role, str(min(body.count("\n"), 4)), str(min(int(words).bit_length(), 12)),
            "?" if body.endswith("?") else "", "A" if body[:1].isupper() else "a" if body[:1].islower() else "")


def render(text: str | None, role: str | None) -> str:
    """Canonical form of one turn."""
    t = text or ""
    return f"<|{role or 'unknown'}|>\n{t[marker(t)[1]:].strip()}\n<|end|>\n"


@dataclass
class RoleModel:
    """Log probabilities; ``emit`` maps (feature number, value) to a vector
    over the roles, ``other`` holds the vector of unseen values."""

    roles: list[str]
    start: np.ndarray
    step: np.ndarray
    emit: dict[tuple[int, str], np.ndarray]
    other: list[np.ndarray]

    @classmethod
    def from_counts(cls, rows: list[tuple[str, str, str, float]]) -> RoleModel:
        """(kind, a, b, n): kind "start" (role a), "step" (role a to b), or a
        feature's name (role a, value b)."""
        roles = sorted({r[1] for r in rows})
        at = {r: i for i, r in enumerate(roles)}
        k = len(roles)
        start, step = np.full(k, SMOOTHING), np.full((k, k), SMOOTHING)
        seen: list[dict[str, np.ndarray]] = [{} for _ in FEATURES]
        for kind, a, b, n in rows:
            if kind == "start":
                start[at[a]] += n
            elif kind == "step":
                step[at[a], at[b]] += n
            else:
                seen[FEATURES.index(kind)].setdefault(b, np.zeros(k))[at[a]] += n
        for role in MARKERS:
            v = seen[0].setdefault(role, np.zeros(k))
            if role in at:
                v[at[role]] += MARKER_BELIEF
        emit, other = {}, []
        for f, values in enumerate(seen):
            total = sum(values.values(), np.zeros(k)) + SMOOTHING * (len(values) + 1)
            emit |= {(f, x): np.log((n + SMOOTHING) / total) for x, n in values.items()}
            other.append(np.log(SMOOTHING / total))
        return cls(roles, np.log(start / start.sum()) if k else start,
                   np.log(step / step.sum(axis=1, keepdims=True)) if k else step, emit, other)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Log likelihood of each unit under each role."""
        return np.array([sum(self.emit.get((f, x), self.other[f]) for f, x in enumerate(observe(t))) for t in texts]) \
            .reshape(len(texts), len(self.roles))

    def transfer(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector from the start of a conversation, matrix from each role
        before) of the best scores to each role at the end of the units."""
        k = len(self.roles)
        m = np.vstack([self.start + e[0], self.step + e[0]])
        for x in e[1:]:
            m = (m[:, :, None] + self.step[None]).max(axis=1) + x
        return m[0], m[1:].reshape(k, k)

    def decode(self, e: np.ndarray, before: int | None = None, end: int | None = None) -> list[int]:
        """Best path, given the role before the units and the last role."""
        a = (self.start if before is None else self.step[before]) + e[0]
        back = []
        for x in e[1:]:
            m = a[:, None] + self.step
            back.append(m.argmax(axis=0))
            a = m.max(axis=0) + x
        path = [int(a.argmax()) if end is None else end]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def _runs(conv: pd.Series) -> list[tuple[int, int]]:
    """[start, end) of the runs of equal conversations (null equals null)."""
    code = pd.factorize(conv, use_na_sentinel=False)[0]
    cut = np.flatnonzero(np.diff(code, prepend=-1, append=-1))
    return list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if len(code) else []


def transcript_blocks(units: DataFrame, conv: str, seq: str, text: str, role: Column | None) -> DataFrame:
    """(conv, seq, text, role, copies, block, pos): the different units and how
    often each is given, range-partitioned and sorted; a block is one partition."""
    rows = units.select(F.col(conv).cast("string").alias("conv"), F.col(seq).alias("seq"), F.col(text).alias("text"),
                        (F.lit(None).cast("string") if role is None else role).alias("role"))
    rows = rows.groupBy("conv", "seq", "text", "role").agg(F.count("*").alias("copies"))
    order = [F.col("conv").asc_nulls_last(), F.col("seq").asc_nulls_last(), F.col("text").asc_nulls_last(),
             F.col("role").asc_nulls_last()]
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .select("*", F.spark_partition_id().alias("block"),
                           F.monotonically_increasing_id().alias("pos")), "transcripts")


def role_counts(blocks: DataFrame) -> DataFrame:
    """(kind, a, b, n) over all labelled units (see ``RoleModel.from_counts``).
    Steps across the border of two blocks are counted from the blocks' edges."""
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        n: dict[tuple, int] = {}
        roles, texts = pdf["role"].tolist(), pdf["text"].tolist()
        runs = _runs(pdf["conv"])
        for j, (a, b) in enumerate(runs):
            for i in range(a, b):
                r = roles[i]
                if not isinstance(r, str):
                    continue
                for f, x in zip(FEATURES, observe(texts[i]), strict=True):
                    n[f, r, x] = n.get((f, r, x), 0) + 1
                if i > a and isinstance(roles[i - 1], str):
                    n["step", roles[i - 1], r] = n.get(("step", roles[i - 1], r), 0) + 1
                elif i == a and j:
                    n["start", r, ""] = n.get(("start", r, ""), 0) + 1
        return pd.DataFrame([(*k, float(v)) for k, v in n.items()], columns=["kind", "a", "b", "n"])

    def edges(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        runs = _runs(pdf["conv"])
        out = [(pdf["conv"].iloc[a], int(pdf["block"].iloc[0]), pdf["role"].iloc[a], pdf["role"].iloc[b - 1], j == 0)
               for j, (a, b) in enumerate(runs) if j in (0, len(runs) - 1)]
        return pd.DataFrame(out, columns=["conv", "block", "first", "last", "head"])

    def borders(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        out, first, last, head = [], pdf["first"].tolist(), pdf["last"].tolist(), pdf["head"].tolist()
        for i, r in enumerate(first):
            if isinstance(r, str):
                if i and isinstance(last[i - 1], str):
                    out.append(("step", last[i - 1], r, 1.0))
                elif not i and head[i]:
                    out.append(("start", r, "", 1.0))
        return pd.DataFrame(out, columns=["kind", "a", "b", "n"])

    kinds = "kind string, a string, b string, n double"
    inside = blocks.groupBy("block").applyInPandas(count, kinds)
    ends = blocks.groupBy("block").applyInPandas(edges, "conv string, block int, first string, last string, head boolean")
    return (inside.unionByName(ends.groupBy("conv").applyInPandas(borders, kinds))
            .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")))


def decode_transcripts(blocks: DataFrame, model: RoleModel) -> DataFrame:
    """(conv, seq, text, role, copies, role_pred, rendered) for every different unit."""
    held = blocks.sparkSession.sparkContext.broadcast(model)

    def transfers(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, m = pdf.sort_values("pos"), held.value
        runs = _runs(pdf["conv"])
        out = []
        for j in sorted({0, len(runs) - 1}):
            a, b = runs[j]
            v, t = m.transfer(m.scores(pdf["text"].iloc[a:b].tolist()))
            out.append((pdf["conv"].iloc[a], int(pdf["block"].iloc[0]), v.tolist(), t.ravel().tolist()))
        return pd.DataFrame(out, columns=["conv", "block", "v", "t"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        """Roles at the borders of one conversation's blocks."""
        pdf = pdf.sort_values("block")
        k = len(held.value.roles)
        mats = [np.array(t).reshape(k, k) for t in pdf["t"]]
        score, back = np.array(pdf["v"].iloc[0]), []
        for t in mats[1:]:
            s = score[:, None] + t
            back.append(s.argmax(axis=0))
            score = s.max(axis=0)
        ends = [int(score.argmax())]
        for b in reversed(back):
            ends.append(int(b[ends[-1]]))
        ends = ends[::-1]
        return pd.DataFrame({"conv": pdf["conv"], "block": pdf["block"], "before": [-1, *ends[:-1]], "end": ends})

    def decode(units: pd.DataFrame, borders: pd.DataFrame) -> pd.DataFrame:
        pdf, m = units.sort_values("pos"), held.value
        runs = _runs(pdf["conv"])
        fixed = {None if pd.isna(c) else c: (b, e) for c, b, e in
                 zip(borders["conv"], borders["before"], borders["end"], strict=True)}
        pred: list[str | None] = []
        for j, (a, b) in enumerate(runs):
            e = m.scores(pdf["text"].iloc[a:b].tolist())
            c = pdf["conv"].iloc[a]
            before, end = fixed[None if pd.isna(c) else c] if j in (0, len(runs) - 1) else (-1, None)
            pred += [m.roles[s] for s in m.decode(e, None if before < 0 else before, end)]
        texts = [t if isinstance(t, str) else None for t in pdf["text"]]
        return pd.DataFrame({"conv": pdf["conv"], "seq": pdf["seq"], "text": texts, "role": pdf["role"], "copies": pdf["copies"], "role_pred": pred,
                             "rendered": [render(t, r) for t, r in zip(texts, pred, strict=True)]})

    out = "conv string, seq string, text string, role string, copies bigint, role_pred string, rendered string"
    if not model.roles:
        none = F.lit(None).cast("string")
        shown = F.concat(F.lit("<|unknown|>\n"), F.trim(F.coalesce("text", F.lit(""))), F.lit("\n<|end|>\n"))
        return blocks.select("conv", "seq", "text", "role", "copies", none.alias("role_pred"), shown.alias("rendered"))
    parts = blocks.groupBy("block").applyInPandas(transfers, "conv string, block int, v array<double>, t array<double>")
    borders = parts.groupBy("conv").applyInPandas(join, "conv string, block int, before int, end int")
    # pandas would make doubles of numbers with nulls: seq travels as text
    units = blocks.withColumn("seq", F.col("seq").cast("string"))
    done = units.groupBy("block").cogroup(borders.groupBy("block")).applyInPandas(decode, out)
    return done.withColumn("seq", F.col("seq").cast(blocks.schema["seq"].dataType))


def format_conversations(units: DataFrame, *, conv: str = "conv_id", seq: str = "turn", text: str = "text",
                         role: str = "role", training: Column | None = None) -> DataFrame:
    """conv, seq, role (the label), role_pred and the rendered turn; learned
    on the labelled units for which ``training`` holds (all by default)."""
    kind = units.schema[conv].dataType
    learn = F.lit(True) if training is None else training
    blocks = transcript_blocks(units, conv, seq, text, F.col(role))
    seen = blocks.withColumn("role", F.when(learn, F.col("role")))
    model = RoleModel.from_counts([tuple(r) for r in role_counts(seen).collect()])
    return (decode_transcripts(blocks, model).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(F.col("conv").cast(kind).alias(conv), F.col("seq").alias(seq), F.col("role").alias(role),
                    "role_pred", "rendered"))
