"""Personal data in free text: contextual extraction bootstrapped from seed entities.

Each text is parsed into mentions: candidates for names, numbers, addresses and email addresses, with an instance (folded
word, shape of a number, street word, form and domain of an email address) and the lexical patterns around it.
Pattern-instance pairs are counted over all texts. Seeds (words of email addresses and words after a title; numbers with an
international prefix or a label; addresses in a street, road or avenue; email addresses written plainly) make patterns
trusted, trusted patterns make further instances known, and so on in joins and aggregations until nothing changes.
Mentions of known instances are then put together to items, unless the pattern before a number speaks against its type.
"""

from __future__ import annotations

import re
import unicodedata
import warnings
from bisect import bisect_left
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators.lookup import lookup
from harborline.session import materialize, spread

TEXTS = ["delivery_instructions", "delivery_notes", "failure_notes"]
#: Share of known mentions that makes a pattern trusted, by kind; share of an instance's mentions in trusted patterns that makes it known.
TRUST = {"name": 0.85, "PHONE": 0.12, "ID_NUMBER": 0.12, "address": 0.04, "email": 0.04}
KNOWN = {"name": 0.6, "PHONE": 0.4, "ID_NUMBER": 0.4, "address": 0.3, "email": 0.3}
#: Mentions that a pattern needs at least; rounds after which a set of known instances that still changes is taken with a warning.
SUPPORT, MOST_ROUNDS = 4, 50
#: A number isn't of its shape's type where the words before it, seen so often at least, hold that type in a lesser share.
REFUTING, REFUTED = 20, 0.02
#: Digits that a phone or identity number has at least.
LEAST_DIGITS = 6
#: Entries of a task's table of pairs before it is handed on.
PAIRS = 200_000

# General words, not taken from any one text
_TITLES = "mr mrs ms miss mx dr prof herr frau sr sra srta señor señora don doña monsieur madame mme mlle signor signora dhr mevr"
_FIRM = (
    "freight tools bakery florist florists store stores shop market supermarket pharmacy clinic hospital school hotel cafe restaurant bar logistics transport transports "
    "cargo couriers shipping foods motors electronics hardware supplies industries services solutions systems group holdings partners associates ltd limited llc inc corp "
    "corporation co company gmbh ag kg bv nv sa sl srl plc sons brothers bros warehouse depot hub terminal"
)
_STREET = (
    "street st road rd avenue ave lane ln drive dr court ct terrace ter way row close boulevard blvd place pl square sq crescent cres parkway pkwy highway hwy alley circle cir "
    "trail grove gardens mews quay walk hill view park rise"
)
_STREET_ENDS = "straße strasse str. weg gasse platz allee damm ufer ring laan straat plein kade gracht dreef steeg"
_STREET_STARTS = "rue avenue boulevard calle avenida av. paseo plaza camino carrera via viale piazza corso rua travessa place chemin allée quai"
_SEED_STREETS = {"street", "st", "road", "rd", "avenue", "ave"}
_UNIT = "flat apt apartment unit suite ste room floor"
_LABELS = (
    r"ssn|social(?: security)?(?: (?:no\.?|number))?|passport(?: (?:no\.?|number))?|national id(?: (?:no\.?|number))?|id card(?: (?:no\.?|number))?|tax id|tin|nif|nie|dni|nino|ni|national insurance(?: (?:no\.?|number))?"
    r"|driver'?s? licen[cs]e(?: (?:no\.?|number))?|driving licen[cs]e|dl|identity card|personalausweis|reisepass|pasaporte|carte d'identité|steuer-id|bsn"
)
_DIGIT_WORDS = "zero one two three four five six seven eight nine oh"
_STOP = set("the a an off at to on of and in by for from with or if is no not as over under between exit dock dock, hub box lamp locker order seal card crate code gate po building floor wind stops pieces pm am min mins kg ft mph degrees".split())

_ALT = lambda words: "|".join(re.escape(w) for w in words.split())
_W = r"[^\W\d_][\w'’ß.-]*"
_DOT = r"(?:\.|\s*[(\[{]\s*dot\s*[)\]}]\s*|\s+dot\s+)"
EMAIL = re.compile(
    rf"(?i)(?<![\w.+-])[\w](?:[\w.+'-]*[\w+])?(?:\s*@\s*|\s*[(\[{{]\s*at\s*[)\]}}]\s*)[a-z0-9](?:[\w-]*\w)?(?:{_DOT}[a-z0-9](?:[\w-]*\w)?)+"
    rf"|(?<![\w.+-])[\w](?:[\w.+'-]*[\w+])?\s+at\s+[a-z0-9](?:[\w-]*\w)?(?:\s+dot\s+[a-z0-9](?:[\w-]*\w)?)+"
)
URL = re.compile(r"(?i)\b(?:https?://|www\.)\S+")
BRACKETED = re.compile(r"\[[A-Z_ ]+\]|<[A-Z_ ]+>|\{[A-Z_ ]+\}")
_HOUSE = r"(?:no\.?\s*|nº\s*|nr\.?\s*|#\s*)?\d{1,5}(?:\s?[a-z](?![\w']))?"
ADDRESS = re.compile(
    rf"(?i)(?<![\w#*./-])\d{{1,5}}[a-z]?,?\s+(?:[nsew]\.?\s+)?(?:(?!(?:{'|'.join(sorted(map(re.escape, _STOP)))})\b){_W}\s+){{1,3}}?(?:{_ALT(_STREET)})(?![\w'])\.?"
    rf"|(?<![\w#*./-])\d{{1,5}}[a-z]?,?\s+(?:{_ALT(_STREET_STARTS)})\s+(?:(?:de|del|de la|du|des|di|da|do|la|le)\s+)?{_W}"
    rf"|\b(?:{_ALT(_STREET_STARTS)})\s+(?:(?:de|del|de la|du|des|di|da|do|la|le)\s+)?{_W}(?:\s+{_W})??,?\s+{_HOUSE}(?![\w-])"
    rf"|(?<![\w'])[^\W\d_][\w'-]*(?:{_ALT(_STREET_ENDS)}),?\s+{_HOUSE}(?![\w-])"
    rf"|(?<![\w'])(?!(?:{'|'.join(sorted(map(re.escape, _STOP)))})\b){_W}\s+(?:{_ALT(_STREET)})\.?,?\s+(?:no\.?|nr\.?|nº|#)\s*\d{{1,5}}[a-z]?(?![\w-])"
)
#: A street word that no list names: one or two words and a house number, for bootstrapping.
UNSEEN_ADDRESS = re.compile(r"(?<![\w#*./-])(?:\d{1,5}[a-z]?\s+[A-Z][\w'ß]+\s+[A-Z][\w'ß]+|[A-Z][\w'ß]{4,}\s+(?:no\.\s*)?\d{1,5}[a-z]?(?![\w-]))")
NUMBER = re.compile(
    rf"(?i)\b[a-z]{{2}}(?:\s?\d{{2}}){{3}}\s?[a-z]\b"
    rf"|(?:tel:\s*)?(?:\+|\b00)\d[\d\s().\-/]{{6,}}\d|\(\d{{2,5}}\)\s?\d[\d\s.\-/]{{4,}}\d"
    rf"|(?<![\w*#/.-])\d(?:[\d.\-/]|\s-\s|\s(?=[\d(])|\(\d\)\s?)*\d(?![\w#*])"
    rf"|(?<![\w*#/.-])(?=[\w-]*\d[\w-]*\d[\w-]*\d)[a-z0-9][\w-]*[a-z0-9](?![\w#*])"
    rf"|\b(?:(?:{_ALT(_DIGIT_WORDS)})[\s-]+){{6,}}(?:{_ALT(_DIGIT_WORDS)})\b"
)
_LABEL = re.compile(rf"(?i)(?<![\w'])(?:{_LABELS})\.?\s*[:#]?\s*")
#: What a text must hold for there to be an email address, or a number in words.
_AT = re.compile(r"(?is)@|[(\[{]\s*at\s*[)\]}]|\bat\b.*?\bdot\b")
_SPOKEN = re.compile(rf"(?i)\b(?:{_ALT(_DIGIT_WORDS)})[\s-]+(?:{_ALT(_DIGIT_WORDS)})\b")
_DIGIT = re.compile(r"\d")
_LOCAL_END = re.compile(r"(?i)\s*@\s*|\s*[(\[{]\s*at\s*[)\]}]\s*|\s+at\s+")
_STREET_WORDS = re.compile(rf"(?i)(?<![\w'])(?:{_ALT(_STREET)}|{_ALT(_STREET_STARTS)})(?![\w'])|(?:{_ALT(_STREET_ENDS)})(?=,?\s)")
_TITLE_SET, _FIRM_SET = set(_TITLES.split()), set(_FIRM.split())
_TOKEN = re.compile(r"[^\W\d_][\w]*(?:['’][^\W\d_]\w+)*")
#: What may stand between a name and the firm word behind it: no number and no end of a sentence.
_FIRM_GAP = re.compile(r"(?!.*[.\n]\s)[^\W\d_\s&'’.-]*(?:[\s&'’.-]+[^\W\d_]*)*")
_CONTEXT = re.compile(r"[^\W\d_][\w'’]*|\d+|[()+&/:;,.\n]")


_FOLDED: dict[str, str] = {}


def fold(word: str) -> str:
    """A word without case, accents and apostrophes."""
    folded = _FOLDED.get(word)
    if folded is None:
        plain = unicodedata.normalize("NFKD", word.replace("ß", "ss"))
        folded = re.sub(r"[^a-z0-9]", "", "".join(c for c in plain if not unicodedata.combining(c)).lower())
        if len(_FOLDED) >= 1 << 16:
            _FOLDED.clear()
        _FOLDED[word] = folded
    return folded


def shape(number: str) -> str:
    if number[0].isalpha() and not any(c.isdigit() for c in number):
        return "digits in words"
    number = re.sub(r"(?i)^tel:\s*", "tel:", re.sub(r"\s+", " ", number))
    kept = number if number.startswith("tel:") else number.upper()
    return re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", kept))


class _Words:
    """Words, numbers and signs of a text in lower case, to be had on either side of a place."""

    def __init__(self, text: str):
        found = [(m.start(), m.end(), m[0].lower()) for m in _CONTEXT.finditer(text)]
        self.starts, self.ends, self.words = ([f[k] for f in found] for k in range(3))

    def before(self, at: int, n: int = 2) -> list[str]:
        k = bisect_left(self.starts, at)
        return self.words[max(0, k - n) : k]

    def after(self, at: int, n: int = 2) -> list[str]:
        k = bisect_left(self.starts, at)
        return self.words[k : k + n]


def mail_instance(found: str) -> str:
    """Form of the at sign and domain of an email address."""
    m = _LOCAL_END.search(found)
    form = "@" if m[0] == "@" else re.sub(r"[^@()\[\]{}a-z]", "", m[0].lower().replace(" ", "_")) + ("" if m[0].strip() == m[0] else " spaced")
    labels = [x for x in re.split(_DOT, found[m.end() :], flags=re.IGNORECASE) if x]
    return f"{form} {'.'.join(labels).lower()}"


def street_instance(found: str) -> str:
    """The word that makes a street of an address: the last one that a list names."""
    words = _STREET_WORDS.findall(found.lower())
    return words[-1].strip(".") if words else "street"


def mentions(text: str) -> list[tuple]:
    """(kind, start, end, instance, patterns, seed, gap) of a text in order; gap is the text since the name word before."""
    taken: list[tuple[int, int]] = []
    out = []
    around = _Words(text)

    def free(a: int, b: int) -> bool:
        return all(b <= x or a >= y for x, y in taken)

    def contexts(a: int, b: int) -> list[str]:
        left, right = around.before(a), around.after(b)
        return ["L2 " + " ".join(left), "L1 " + (left or [""])[-1], f"L1R1 {(left or [''])[-1]} _ {(right or [''])[0]}"]

    names = []
    for m in EMAIL.finditer(text) if _AT.search(text) else ():
        taken.append(m.span())
        instance = mail_instance(m[0])
        out.append(("email", *m.span(), instance, contexts(*m.span()), "email" if instance.startswith("@ ") else "", ""))
        local = _LOCAL_END.split(m[0])[0].split("+")[0]
        names += [fold(x) for x in re.split(r"[\W\d_]+", local) if len(x) > 2]
    for m in [*URL.finditer(text), *BRACKETED.finditer(text)]:
        taken.append(m.span())
    digits = _DIGIT.search(text) is not None
    for m in ADDRESS.finditer(text) if digits else ():
        if free(*m.span()):
            taken.append(m.span())
            instance = street_instance(m[0])
            out.append(("address", *m.span(), instance, contexts(*m.span()), "address" if instance in _SEED_STREETS else "", ""))
    for m in UNSEEN_ADDRESS.finditer(text) if digits else ():
        if free(*m.span()) and not (set(re.findall(r"[a-z]+", m[0].lower())) & (_STOP | set(_UNIT.split()))):
            word = re.findall(r"[^\W\d_]{3,}", m[0])
            out.append(("address", *m.span(), "word " + fold(word[-1] if word else m[0]), contexts(*m.span()), "", ""))
    labels = {m.end(): m.start() for m in _LABEL.finditer(text)} if digits else {}
    for m in NUMBER.finditer(text) if digits or _SPOKEN.search(text) else ():
        a, b = m.span()
        n = sum(c.isdigit() for c in m[0])
        if not free(a, b) or (n < LEAST_DIGITS and not m[0][0].isalpha()):
            continue
        s = shape(m[0])
        seed = "ID_NUMBER" if a in labels else "PHONE" if s.startswith(("+", "tel:")) and 9 <= n <= 15 else ""
        left, right = around.before(labels.get(a, a)), around.after(b)
        taken.append((a, b))
        out.append(("number", a, b, s, ["L2 " + " ".join(left), f"L1R1 {(left or [''])[-1]} _ {(right or [''])[0]}"], seed, ""))
    last = 0
    tokens = [m for m in _TOKEN.finditer(text) if free(*m.span())]
    lower = [m[0].lower() for m in tokens]
    any_firm = not _FIRM_SET.isdisjoint(lower)
    for k, m in enumerate(tokens):
        a, b = m.span()
        word = m[0][:-2] if m[0][-2:] in ("'s", "’s", "'S", "’S") else m[0]
        if len(word) < 2:
            continue
        firm = False
        for j in range(k + 1, min(k + 4, len(tokens))) if any_firm else ():
            if not _FIRM_GAP.fullmatch(text, b, tokens[j].start()):
                break
            if lower[j] in _FIRM_SET:
                firm = j - k <= 2 and (tokens[j][0][0].isupper() or m[0].islower())
                break
            if j > k + 1 and lower[j] == tokens[j][0] and lower[j] in _STOP:
                break
        left, right = around.before(a, 3), around.after(b)
        previous = [w for w in left if w not in "().,"]
        left = left[-2:]
        seed = "name" if previous and previous[-1] in _TITLE_SET else ""
        patterns = [] if firm else ["L2 " + " ".join(left), "R2 " + " ".join(right), f"L1R1 {(left or [''])[-1]} _ {(right or [''])[0]}"]
        out.append(("firm" if firm else "name", a, b, fold(word), patterns, seed, text[last:a]))
        last = b
    out += [("seed", 0, 0, n, [], "name", "") for n in names]
    return out


_ARROW = pa.schema([
    ("record_id", pa.int64()), ("field_name", pa.string()), ("text_no", pa.int64()), ("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32()),
    ("instance", pa.string()), ("pattern", pa.string()), ("gap", pa.string()), ("counted", pa.string()), ("n", pa.int64()),
])
_MENTION = "record_id bigint, field_name string, text_no bigint, kind string, first int, last int, instance string, pattern string, gap string, counted string, n bigint"


def _parse(batches):
    """A row per mention (with the pattern before it, but for names), and rows of counts: `counted` is pair, mention or seed and its type."""
    count: Counter = Counter()

    def counts():
        rows = [(None, None, None, kind, None, None, instance, pattern, None, what, n) for (what, kind, instance, pattern), n in count.items()]
        count.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * len(_ARROW), _ARROW)], schema=_ARROW)

    for batch in batches:
        columns: list[list] = [[] for _ in _ARROW]
        for key in zip(*(batch.column(c).to_pylist() for c in ("record_id", "field_name", "text_no", "text"))):
            for kind, first, last, instance, patterns, seed, gap in mentions(key[3]):
                if kind not in ("seed", "firm"):
                    count["mention", kind, instance, None] += 1
                    for p in patterns:
                        count["pair", kind, instance, p] += 1
                if seed:
                    count["seed " + seed, "name" if kind == "seed" else kind, instance, None] += 1
                if kind != "seed":
                    for c, v in zip(columns, (*key[:3], kind, first, last, instance, patterns[0] if kind not in ("name", "firm") else None, gap, None, None)):
                        c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
        if len(count) >= PAIRS:
            yield counts()
    yield counts()


def texts(records: DataFrame) -> DataFrame:
    """(record_id, field_name, text_no, text) of each text that isn't blank; text_no tells repeated record_ids apart. Rows without a record_id have none."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in TEXTS])).alias("x")
    rows = records.select("record_id", each).select("record_id", "x.*").where("record_id IS NOT NULL AND text IS NOT NULL AND text RLIKE r'\\S'")
    return rows.withColumn("text_no", F.xxhash64("text"))


def _by_type(values: dict[str, float]):
    return F.expr("CASE type " + " ".join(f"WHEN '{t}' THEN {v}" for t, v in values.items()) + " END")


def _pattern_shares(graph: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, pattern, type, share, support): the share of a pattern's mentions that are of known instances."""
    key = lambda c: F.concat_ws("\t", "kind", c, "type")
    marked = lookup(graph.withColumn("_k", key("instance")), known.select(key("instance").alias("_k"), F.lit(1).alias("hit")), "_k", "pattern", written=True)
    return marked.groupBy("kind", "pattern", "type").agg((F.sum(F.when(F.col("hit") == 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("share"), F.sum("n").alias("support"))


def bootstrap(found: DataFrame, rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Known instances (key, type) and pattern shares (kind, pattern, type, share, support), from counts over all mentions.

    Runs until the known instances stay as they are, or for `rounds`. The graph has a row per distinct pattern and
    instance, so its size follows the vocabulary, not the texts; frequent instances and patterns are never joined by their bare keys.
    """
    count = lambda what: found.where(F.col("counted").startswith(what))
    graph = materialize(count("pair").groupBy("kind", "instance", "pattern").agg(F.sum("n").alias("n")), "graph")
    families = F.expr("CASE kind WHEN 'number' THEN array('PHONE', 'ID_NUMBER') ELSE array(kind) END")
    graph = graph.withColumn("type", F.explode(families))
    totals = count("mention").groupBy("kind", "instance").agg(F.sum("n").alias("m"))
    seeded = count("seed").groupBy("kind", "instance", F.substring_index("counted", " ", -1).alias("type")).agg(F.sum("n").alias("s"))
    # a shape is a seed where a fair share of its mentions is; a word needs two witnesses, as anything may stand in an address
    known = seeded.join(totals, ["kind", "instance"]).where("CASE kind WHEN 'name' THEN s >= 2 AND s >= 0.02 * m ELSE s >= 0.05 * m END").select("kind", "instance", "type")
    known = seeds = materialize(known, "known")
    key = lambda c: F.concat_ws("\t", "kind", c, "type")
    done, before = 0, None
    while rounds is None or done < rounds:
        judged = _pattern_shares(graph, known).where(F.col("support") >= SUPPORT)
        judged = judged.select(key("pattern").alias("_k"), (F.col("share") >= _by_type(TRUST)).alias("ok"))
        scored = lookup(graph.withColumn("_k", key("pattern")), judged, "_k", "instance")
        # addresses come in few patterns, so that rare ones say nothing about them
        counts = F.when(F.col("kind").isin("name", "number") | F.col("ok").isNotNull(), F.col("n"))
        scored = scored.groupBy("kind", "instance", "type").agg(F.try_divide(F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0)), F.sum(counts)).alias("share"))
        # a seed must be borne out by its contexts as well, though less
        scored = scored.join(seeds.withColumn("is_seed", F.lit(True)), ["kind", "instance", "type"], "left")
        held = scored.where((F.col("share") >= _by_type(KNOWN)) | (F.col("is_seed") & (F.col("share") >= 0.25 * _by_type(KNOWN))))
        known = materialize(held.groupBy("kind", "instance").agg(F.max_by("type", "share").alias("type")), "known")
        done += 1
        state = known.agg(F.count("*"), F.sum(F.xxhash64("kind", "instance", "type").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
        if done >= MOST_ROUNDS:
            warnings.warn(f"known instances still change after {done} rounds", stacklevel=2)
            break
    return known.select(F.concat_ws(" ", "kind", "instance").alias("key"), "type"), _pattern_shares(graph, known)


_FAMILY_FIRST = re.compile(r"\s*,\s+")
_JOINED = re.compile(r"-|\s+(?:[^\W\d_]\.?\s+)*|\.\s+(?:[^\W\d_]\.\s+)*")


def assemble(found: list) -> list[tuple[str, int, int, int]]:
    """(pii_type, item_no, first, last) of a text from its known mentions (type, first, last, gap, kind)."""
    items: list[list] = []
    run: list = []
    solid = [(a, b) for t, a, b, _, _ in found if t != "word"]  # an address of an unlisted street word gives way to anything else

    def close():
        if run and any(w not in _TITLE_SET for w in run[3]):
            items.append(["PERSON_NAME", run[0], run[1]])
        run.clear()

    last = None
    for kind, a, b, gap, word in sorted(found, key=lambda x: (x[1], -x[2])):
        if kind in ("name", "word"):
            if kind == "word":
                close()
            else:
                space = gap if last is not None else None
                if run and space is not None and "\n" not in space and (re.fullmatch(_JOINED, space) or (re.fullmatch(_FAMILY_FIRST, space) and run[2] == 1)) and (not space.startswith(".") or run[3][-1] in _TITLE_SET):
                    run[1], run[2] = b, run[2] + (word not in _TITLE_SET)
                    run[3].append(word)
                else:
                    close()
                    run.extend([a, b, int(word not in _TITLE_SET), [word]])
            last = b
        elif kind == "address":
            if not word.startswith("word ") or all(b <= x or a >= y for x, y in solid if (x, y) != (a, b)):
                items.append(["STREET_ADDRESS", a, b])
        else:
            items.append([kind, a, b])
    close()
    out, count = [], {}
    for t, a, b in sorted(items, key=lambda x: x[1]):
        count[t] = count.get(t, 0) + 1
        out.append((t, count[t], a, b))
    return out


def _put_together(found: pd.Series) -> pd.Series:
    return found.map(lambda xs: [{"pii_type": t, "item_no": n, "first": a, "last": b} for t, n, a, b in assemble([(x["type"], x["first"], x["last"], x["gap"], x["instance"]) for x in xs])])


def items(records: DataFrame) -> DataFrame:
    """(record_id, field_name, text_no, pii_type, item_no, first, last): each item with its place in the text.

    Null and blank texts have none. A record that occurs twice in full gives its items once; placeholders that a text
    already has are no items. What is gathered per text is bounded by the text.
    """
    put = F.pandas_udf(_put_together, "array<struct<pii_type: string, item_no: int, first: int, last: int>>")
    found = materialize(spread(texts(records)).mapInArrow(_parse, _MENTION), "mentions")
    known, shares = bootstrap(found)
    here = found.where("counted IS NULL").select("record_id", "field_name", "text_no", "kind", "first", "last", "instance", "pattern", "gap", F.concat_ws(" ", "kind", "instance").alias("key"))
    typed = lookup(here, known, "key", "record_id", written=True)
    typed = typed.withColumn("type", F.expr("CASE WHEN kind IN ('name', 'firm') AND (type IS NULL OR kind = 'firm') THEN 'word' WHEN kind = 'email' AND type IS NOT NULL THEN 'EMAIL' ELSE type END")).where("type IS NOT NULL")
    # the words before a number may speak against the type of its shape
    refuted = shares.where((F.col("kind") == "number") & (F.col("support") >= REFUTING) & (F.col("share") < REFUTED))
    refuted = refuted.select(F.concat_ws("\t", "type", "pattern").alias("_at"), F.lit(True).alias("refuted"))
    typed = lookup(typed.withColumn("_at", F.when(F.col("kind") == "number", F.concat_ws("\t", "type", "pattern"))), refuted, "_at", "record_id").where("refuted IS NULL")
    grouped = typed.groupBy("record_id", "field_name", "text_no").agg(F.collect_set(F.struct("type", "first", "last", "gap", "instance")).alias("found"))
    grouped = grouped.where(F.exists("found", lambda x: x["type"] != "word"))
    return grouped.select("record_id", "field_name", "text_no", F.explode(put("found")).alias("x")).select("record_id", "field_name", "text_no", "x.*")


def _masked(text: pd.Series, found: pd.Series) -> pd.Series:
    def one(t, xs):
        for x in sorted(xs if xs is not None else [], key=lambda x: -x["first"]):
            t = t[: x["first"]] + f"[{x['pii_type']}]" + t[x["last"] :]
        return t

    return pd.Series([one(t, xs) for t, xs in zip(text, found)])


def masked(records: DataFrame) -> DataFrame:
    """(record_id, field_name, text): each text with its items replaced by typed placeholders, all else unchanged."""
    found = items(records).groupBy("record_id", "field_name", "text_no").agg(F.collect_list(F.struct("pii_type", "first", "last")).alias("found"))
    rows = texts(records).dropDuplicates(["record_id", "field_name", "text_no"]).join(found, ["record_id", "field_name", "text_no"], "left")
    return rows.select("record_id", "field_name", F.pandas_udf(_masked, "string")("text", "found").alias("text"))
