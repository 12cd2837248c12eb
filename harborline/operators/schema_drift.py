"""Schemas that drift between files: similarity flooding over schema graphs, a report of changes, one table per type.

Each file is reduced to a profile of its field paths: JSON types and a bounded histogram of content tokens. The profiles
of consecutive files of a feed become two graphs of names, types and nesting; match scores are propagated between them
until they converge, and a consistent set of correspondences is selected. A field without a partner is added or
removed, one with another path is renamed, one with other types is retyped.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators.lookup import lookup
from harborline.session import materialize, spread

#: Hash buckets for shapes and for words of a field in a content histogram, which bound its size.
SHAPES, WORDS = 1 << 16, 1 << 16
#: Levels of nesting beyond which a payload counts as unreadable.
DEEPEST = 200
#: Weight of a text's kinds of characters beside its values: a share, and a few records as long as values are too rare to tell.
LIGHT, FEW = 0.22, 2.0
#: Least converged score of a correspondence between different paths; least content similarity of one whose names aren't as like as LIKE_NAME.
LEAST_SCORE, LEAST_CONTENT, LIKE_NAME = 0.5, 0.55, 0.8
#: Share of names in the start values, share of a score that flows on, change below which scores have converged. The iteration is a
#: normalised positive affine map, which converges; beyond MOST_ROUNDS it is an error.
NAME_WEIGHT, FLOW, EPSILON, MOST_ROUNDS = 0.35, 0.4, 1e-4, 10_000


def kind_of(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, (int, float)):
        return "number"
    return {str: "string", list: "array", dict: "object"}[type(v)]


def flatten(o: dict, prefix: str = ""):
    """(path, value) of each key of an object and of the objects in it; paths are dotted."""
    stack = [(prefix, o)]
    while stack:
        p, d = stack.pop()
        for k, v in d.items():
            yield p + k, v
            if isinstance(v, dict):
                stack.append((f"{p}{k}.", v))


def _refuse(constant: str):
    raise ValueError(constant)


def _too_deep(text: str) -> bool:
    if text.count("[") + text.count("{") <= DEEPEST:
        return False
    depth = 0
    for m in re.finditer(r'"(?:[^"\\]|\\.)*"|[\[{\]}]', text):
        depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(m[0], 0)
        if depth > DEEPEST:
            return True
    return False


def readable(payload: str | None) -> dict | None:
    """The object in a payload; None if it is cut off, isn't JSON (NaN and Infinity aren't), isn't an object or is nested too deep."""
    try:
        o = json.loads(payload, parse_constant=_refuse) if payload and not _too_deep(payload) else None
    except (ValueError, RecursionError):
        return None
    return o if isinstance(o, dict) else None


def tokens(v) -> list[str]:
    """Content tokens of a value: what stays the same when a field is only renamed. All elements of an array count."""
    if isinstance(v, list):
        out, stack = [], [("a", x) for x in v]
        while stack:
            prefix, x = stack.pop()
            if isinstance(x, list):
                stack += [(prefix + "a", y) for y in x]
            else:
                out += [prefix + t for t in tokens(x)]
        return out or ["a"]
    if isinstance(v, bool):
        return [f"b{v}"]
    if isinstance(v, (int, float)):
        decimals = len(repr(v).partition(".")[2]) if isinstance(v, float) else 0
        if isinstance(v, float) and math.isinf(v):  # written with an exponent beyond doubles
            return ["m-inf" if v < 0 else "minf", "d0"]
        size = f"i{v}" if decimals == 0 and abs(v) < 10 else f"m{'-' if v < 0 else ''}{int(math.log2(abs(v))) if v else 0}"
        return [size, f"d{min(decimals, 3)}"]
    if isinstance(v, str):
        shape = re.sub(r"(.)\1{2,}", r"\1+", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", v)))) if re.search(r"\d", v) else ""
        lead = re.match(r"[A-Za-z]*", v)[0]
        if shape:
            return [f"s{zlib.crc32(shape.encode("utf-8", "surrogatepass")) % SHAPES}", f"l{zlib.crc32(lead.encode()) % WORDS}"]
        kinds = sorted({"A" if c.isupper() else "a" if c.isalpha() else " " if c.isspace() else "." for c in v})
        return [f"w{zlib.crc32(v.encode("utf-8", "surrogatepass")) % WORDS}", f"k{''.join(kinds)}"]
    return []


def _profile(batches):
    for pdf in batches:
        count: Counter = Counter()
        for feed, no, payload in zip(pdf.feed_id, pdf.file_no, pdf.payload):
            o = readable(payload)
            if o is None:
                continue
            count[feed, no, "", "file", ""] += 1
            for path, v in flatten(o):
                kind = kind_of(v)
                count[feed, no, path, kind, ""] += 1
                for t in tokens(v):
                    count[feed, no, path, kind, t] += 1
        yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=["feed_id", "file_no", "path", "kind", "token", "n"])


def profiles(landed: DataFrame) -> DataFrame:
    """(feed_id, file_no, path, kind, token, n): counts over all readable records, combined before the shuffle.

    Rows without a feed or file number belong to no file and are left out. Files landed twice count double, which
    changes no share. The row with path '' and kind 'file' stands for the file itself.
    """
    rows = landed.select("feed_id", "file_no", "payload").where("feed_id IS NOT NULL AND file_no IS NOT NULL")
    parts = spread(rows).mapInPandas(_profile, "feed_id string, file_no bigint, path string, kind string, token string, n bigint")
    return materialize(parts.groupBy("feed_id", "file_no", "path", "kind", "token").agg(F.sum("n").alias("n")), "profiles")


def _grams(name: str) -> Counter:
    plain = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()
    padded = f"  {re.sub(r'[^a-z0-9]', ' ', plain)} "
    return Counter(padded[i : i + 3] for i in range(len(padded) - 2))


def _cosine(a: dict, b: dict) -> float:
    if not a or not b:
        return 0.0
    dot = sum(n * b.get(k, 0) for k, n in a.items())
    return dot / math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))


def _common(a: dict, b: dict) -> float:
    """Share of two fields' texts whose value the other field has too; 0 for other values, whatever they look like."""
    words = [{t: n for t, n in x.items() if t.lstrip("a").startswith("w")} for x in (a, b)]
    shares = [sum(n for t, n in x.items() if t in y) / max(sum(x.values()), 1) for x, y in (words, words[::-1])]
    return sum(shares) / 2


def _heads(path: str) -> list[str]:
    """The paths of the containers that a path is in."""
    return [path[:k] for k, c in enumerate(path) if c == "."]


class Schema:
    """Fields of one file: kinds and tokens by path; inner keys of fields that are (or were) plain values are left out."""

    def __init__(self, rows, leafy: set[str]):
        self.kinds: dict[str, set[str]] = defaultdict(set)
        self.tokens: dict[str, Counter] = defaultdict(Counter)
        owners: dict[str, str] = {}
        for p, k, t, n in rows:
            if not p:
                continue
            if p not in owners:
                owners[p] = min((h for h in _heads(p) if h in leafy), key=len, default="")
            if not owners[p] and not t:
                self.kinds[p].add(k)
            if t:
                self.tokens[owners[p] or p][t] += LIGHT * n + FEW if t.lstrip("a").startswith("k") else n
        parents = {p.rpartition(".")[0] for p in self.kinds}
        self.fields = {p for p, k in self.kinds.items() if p in leafy or k - {"object", "null"} or p not in parents}
        self.nodes = sorted(self.kinds)

    def types(self, p: str) -> set[str]:
        return self.kinds[p] - {"null"}


def flood(old: Schema, new: Schema) -> tuple[np.ndarray, np.ndarray]:
    """Content similarity and converged match scores of all nodes of two schema graphs (old by new).

    Scores are on the scale of their start values: a start value plus what flows in from containers and inner fields.
    """
    a, b = old.nodes, new.nodes
    content = np.array([[_cosine(old.tokens.get(p, {}), new.tokens.get(q, {})) for q in b] for p in a]).reshape(len(a), len(b))
    names_a, names_b = [_grams(p.rpartition(".")[2]) for p in a], [_grams(q.rpartition(".")[2]) for q in b]
    names = np.array([[_cosine(x, y) for y in names_b] for x in names_a]).reshape(len(a), len(b))
    same = np.array([[p == q for q in b] for p in a], dtype=float).reshape(len(a), len(b))
    typed = np.array([[float(not old.types(p) or not new.types(q) or bool(old.types(p) & new.types(q))) for q in b] for p in a]).reshape(len(a), len(b))
    common = np.array([[_common(old.tokens.get(p, {}), new.tokens.get(q, {})) for q in b] for p in a]).reshape(len(a), len(b))
    # texts of common values are the same whatever their names
    start = np.maximum(same, typed * np.maximum((1 - NAME_WEIGHT) * content + NAME_WEIGHT * names, common))
    up = lambda nodes: np.array([[float(q == p.rpartition(".")[0]) for q in nodes] for p in nodes]).reshape(len(nodes), len(nodes))
    pa, pb = up(a), up(b)
    inner = np.maximum(1, np.maximum(pa.sum(0)[:, None], pb.sum(0)[None, :]))
    flow = lambda m: FLOW * typed * (pa @ m @ pb.T + pa.T @ m @ pb / inner)
    score = start.copy()
    for _ in range(MOST_ROUNDS):
        after = start + 0.5 * score + flow(score)
        after /= max(after.max(initial=0), 1e-9)
        if np.abs(after - score).max(initial=0) < EPSILON:
            break
        score = after
    else:
        raise ArithmeticError("match scores do not converge")
    return content, start + flow(score)


def compare(old: Schema, new: Schema) -> list[tuple[str, str, str]]:
    """(change_kind, field_path, new_path) between two schemas."""
    out = [("retyped", p, "") for p in sorted(old.fields & new.fields) if old.types(p) and new.types(p) and old.types(p) != new.types(p)]
    gone, come = sorted(old.fields - new.fields), sorted(new.fields - old.fields)
    # a plain field that became a container of others, or the reverse, is no removal
    gone = [p for p in gone if p not in new.kinds]
    come = [q for q in come if q not in old.kinds]
    if gone and come:
        content, score = flood(old, new)
        at_a, at_b = {p: i for i, p in enumerate(old.nodes)}, {q: i for i, q in enumerate(new.nodes)}
        pairs = []
        for p in gone:
            for q in come:
                c, s = content[at_a[p], at_b[q]], score[at_a[p], at_b[q]]
                if old.types(p) == new.types(q) and s >= LEAST_SCORE:
                    tail_p, tail_q = p.rpartition(".")[2], q.rpartition(".")[2]
                    name = _cosine(_grams(tail_p), _grams(tail_q))
                    # flags and other contents of a few values say little: the names must agree as well
                    if old.types(p) == {"boolean"} and name < 0.2:
                        continue
                    if c >= LEAST_CONTENT or name >= LIKE_NAME:
                        pairs.append((s, p, q))
        used: set[str] = set()
        for _, p, q in sorted(pairs, key=lambda x: (-x[0], x[1], x[2])):
            if f"-{p}" not in used and f"+{q}" not in used:
                used |= {f"-{p}", f"+{q}"}
                out.append(("renamed", p, q))
        gone, come = [p for p in gone if f"-{p}" not in used], [q for q in come if f"+{q}" not in used]
    return out + [("removed", p, "") for p in gone] + [("added", q, "") for q in come]


_CHANGE = pa.schema([("feed_id", pa.string()), ("file_no", pa.int64()), ("change_kind", pa.string()), ("field_path", pa.string()), ("new_path", pa.string())])


def _pair(group: pa.Table) -> pa.Table:
    feed, no = group.column("feed_id")[0].as_py(), group.column("file_no")[0].as_py()
    sides: dict[str, list] = {"old": [], "new": []}
    leafy = set()
    for side, path, kind, token, n, plain in zip(*(group.column(c).to_pylist() for c in ("side", "path", "kind", "token", "n", "leafy"))):
        sides[side].append((path, kind, token, n))
        if plain:
            leafy.add(path)
    found = compare(Schema(sides["old"], leafy), Schema(sides["new"], leafy))
    return pa.Table.from_pylist([dict(zip(_CHANGE.names, (feed, no, *x))) for x in found], schema=_CHANGE)


def changes(profile: DataFrame) -> DataFrame:
    """(feed_id, file_no, change_kind, field_path, new_path): each change against the file before.

    Only pairs of files whose paths or kinds differ are compared, and content is only looked at where a path went and
    another came. A group is the two profiles of such a pair, bounded by the width of their schemas, not by their
    records. A file whose predecessor is missing is compared with nothing.
    """
    plain = profile.where("kind NOT IN ('object', 'null', 'file')").groupBy("feed_id", "path").agg(F.min("file_no").alias("first_plain"))
    later = lambda df: df.withColumn("file_no", F.col("file_no") + 1)
    # a mark per path, the file itself being '', and one per kind at it that says something
    kinds = F.array_compact(F.array(F.lit(""), F.when(~F.col("kind").isin("null", "file"), F.col("kind"))))
    marks = profile.where("token = ''").select("feed_id", "file_no", "path", F.explode(kinds).alias("mark")).distinct()
    sides = marks.withColumn("there", F.lit(1)).unionByName(later(marks).withColumn("there", F.lit(2))).groupBy("feed_id", "file_no", "path", "mark").agg(F.sum("there").alias("there"))
    only = lambda side: F.bool_or((F.col("there") == side) & (F.col("mark") == ""))
    pairs = sides.groupBy("feed_id", "file_no").agg(F.bool_or((F.col("path") == "") & (F.col("there") == 3)).alias("both"), F.bool_or(F.col("there") != 3).alias("differ"), (only(1) & only(2)).alias("moved"))
    pairs = pairs.where("both AND differ").select("feed_id", "file_no", "moved")
    sided = profile.withColumn("side", F.lit("new")).unionByName(later(profile).withColumn("side", F.lit("old")))
    both = sided.join(pairs, ["feed_id", "file_no"]).where("token = '' OR moved").join(plain, ["feed_id", "path"], "left")
    both = both.withColumn("leafy", F.coalesce(F.col("first_plain") <= F.col("file_no"), F.lit(False))).drop("first_plain", "moved")
    return both.groupBy("feed_id", "file_no").applyInArrow(_pair, "feed_id string, file_no bigint, change_kind string, field_path string, new_path string")


def roots(renames: DataFrame) -> DataFrame:
    """(feed_id, path, since, root): the first name of each renamed path, from file `since` on, by pointer jumping."""
    edges = materialize(renames.select("feed_id", F.col("new_path").alias("path"), F.col("file_no").alias("since"), F.col("field_path").alias("root"), F.col("file_no").alias("at")), "edges")
    base = edges.selectExpr("feed_id AS _feed", "path AS _p", "since AS _s", "root AS _r", "at AS _a")
    while True:
        hop = edges.join(base, F.expr("feed_id = _feed AND root = _p AND _s < at"), "left")
        latest = hop.groupBy("feed_id", "path", "since", "root", "at").agg(F.max(F.when(F.col("_s").isNotNull(), F.struct("_s", "_r", "_a"))).alias("b"))
        after = materialize(latest.select("feed_id", "path", "since", F.coalesce("b._r", "root").alias("root"), F.coalesce("b._a", "at").alias("at")), "edges")
        if after.join(edges, ["feed_id", "path", "since", "root", "at"], "left_anti").isEmpty():
            return after.drop("at")
        edges = after


def mapping(profile: DataFrame, change: DataFrame) -> DataFrame:
    """(file_key, names): for each file, a map of each renamed path to the field's first name in its feed."""
    root = roots(change.where("change_kind = 'renamed'"))
    until = F.lead("since").over(Window.partitionBy("feed_id", "path").orderBy("since"))
    spans = root.withColumn("until", until)
    paths = profile.where("path <> ''").select("feed_id", "file_no", "path").distinct()
    valid = paths.join(spans, ["feed_id", "path"]).where("file_no >= since AND (until IS NULL OR file_no < until)")
    named = valid.groupBy("feed_id", "file_no").agg(F.map_from_entries(F.collect_list(F.struct("path", "root"))).alias("names"))
    return named.select(F.to_json(F.struct("feed_id", "file_no")).alias("file_key"), "names")


def _unify(batches):
    for pdf in batches:
        out = []
        for payload, names in zip(pdf.payload, pdf.names):
            o = readable(payload)
            names = dict(names) if names is not None else {}
            flat: dict[str, str | None] = {}
            for path, v in flatten(o or {}):
                renamed = names.get(path)
                if renamed is None:
                    head = path
                    while "." in head and renamed is None:
                        head = head.rpartition(".")[0]
                        renamed = names[head] + path[len(head) :] if head in names else None
                if not isinstance(v, dict):
                    flat[renamed or path] = v if isinstance(v, str) or v is None else json.dumps(v)
            out.append(flat if o is not None else None)
        yield pdf.drop(columns=["payload", "names"]).assign(fields=out)


def unified(landed: DataFrame, event_type: str, profile: DataFrame | None = None, change: DataFrame | None = None) -> DataFrame:
    """One table of an event type with a stable column per field (dots become __), whatever it was called in its file.

    A column is double or boolean where all plain values of the field have that one JSON type, else string; objects a
    field turned into are further columns. A file landed twice gives its records once (by feed, file and event_id).
    Unreadable payloads have null in every field and readable = false.
    """
    landed = landed.where(F.col("event_type") == event_type)
    profile = profiles(landed) if profile is None else profile
    change = change if change is not None else materialize(changes(profile), "changes")
    rows = landed.select(F.col("record_id").cast("string").alias("record_id"), "feed_id", "file_no", "event_id", "event_time", "payload")
    rows = rows.withColumn("file_key", F.to_json(F.struct("feed_id", "file_no")))
    rows = lookup(rows, mapping(profile, change), "file_key", "record_id").drop("file_key").withColumn("file_no", F.col("file_no").cast("string"))
    flat = rows.mapInPandas(_unify, "record_id string, feed_id string, file_no string, event_id string, event_time timestamp, fields map<string,string>")
    flat = flat.withColumns({c: F.col(c).cast("long") for c in ("record_id", "file_no")})
    first = flat.groupBy("feed_id", "file_no", F.coalesce("event_id", F.concat(F.lit("row "), F.col("record_id").cast("string"))).alias("_id")).agg(F.min_by(F.struct("record_id", "event_id", "event_time", "fields"), "record_id").alias("r"))
    flat = materialize(first.select("r.record_id", "feed_id", "file_no", "r.event_id", "r.event_time", "r.fields"), "unified")
    # as many rows as the type has fields
    kinds = flat.select(F.explode("fields")).where("value IS NOT NULL").groupBy("key").agg(F.bool_and(F.col("value").try_cast("double").isNotNull()).alias("number"), F.bool_and(F.col("value").isin("true", "false")).alias("flag"), F.bool_or(F.col("value").rlike(r"^0\d")).alias("padded"))
    cols = [F.col("fields")[k.key].try_cast("double" if k.number and not k.padded else "boolean" if k.flag else "string").alias(k.key.replace(".", "__")) for k in sorted(kinds.collect(), key=lambda r: r.key)]
    return flat.select("record_id", "feed_id", "file_no", "event_id", "event_time", F.col("fields").isNotNull().alias("readable"), *cols)
