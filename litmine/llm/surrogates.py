"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Detected are e-mail addresses, IPv4 addresses, payment card numbers, phone numbers, access keys, passwords and names of persons
after a form of address. A secret is what stands after a word such as password or token (also at the end of a longer word, or followed by _ or -),
white space if any, ``=`` or ``:``, and an opening quote if any: up to the closing quote, else up to white space, less trailing marks. A phone number has 7 to 15 digits: after a plus, in groups after an area code in brackets, after a zero, or in
other groups that aren't dates, years or numbers with thousands apart. Persons are all capitalised names after a form of address (in capitals throughout, where
names can't be told from words: two), and further mentions of these names in the same text. A surrogate is a function of a secret key, the entity's kind and its normal form
(digits only, lower case, single name), so one entity gets one surrogate in all documents and spellings. It keeps
length, letter case, digits and separators; a card keeps whether its check digit holds, an address its private range, a
name its script and the gender of the forms of address before it in the corpus, none if they differ.

Distinctness is checked over the whole corpus: distinct entities are gathered, and one whose surrogate is also
that of another or is itself an entity of the corpus draws again, until no collision is left. From the third draw on a surrogate
grows with the number of the draw (an address gets numbers above 255), and one without anything to replace grows at once, so there is
always a free one, however short or alike the entities are. Only entities that
drew again are carried back to the documents; the others are computed where they stand. If those few don't fit a measured
broadcast, they meet their documents in a join.

Null texts stay null. Repeated rows get equal texts. All other columns stay; ``n_entities`` and ``kinds`` are replaced.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litmine.llm import arrays as A
from litmine.operators.sizing import fits_broadcast
from litmine.session import written

# Forms of address and the gender that they show.
ADDRESS = {
    "mr": "m", "mr.": "m", "sir": "m", "herr": "m", "herrn": "m", "monsieur": "m", "m.": "m", "señor": "m", "sr.": "m", "don": "m", "г-н": "m",
    "mrs": "f", "mrs.": "f", "ms": "f", "ms.": "f", "miss": "f", "frau": "f", "madame": "f", "mme": "f", "mme.": "f", "señora": "f",
    "sra.": "f", "doña": "f", "г-жа": "f", "dr.": "u", "prof.": "u",
}
SYLLABLES = {
    "latin": ("b br c d dr f g gr h j k l m n p r s st t tr v w z".split(), "a e i o u".split(), {"m": "n r s l".split(), "f": "a ia ea".split(), "u": "e in el".split()}),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у".split(), {"m": "н р с л".split(), "f": "а ия ея".split(), "u": "е ин ел".split()}),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ".split(), "α ε η ι ο".split(), {"m": "ς ν ρ".split(), "f": "α ια εα".split(), "u": "ε ιν ελ".split()}),
}
SECRET_WORDS = ("password", "passwd", "passphrase", "pwd", "secret", "token", "api_key", "api-key", "apikey")
_SIGN = r"""(?:[_-][\w-]{0,40})?\\?["'`]?[ \t\r\n]*(?::=|=>|==?|:)"""
_SECRET_SIGN = re.compile(_SIGN.encode())
# After '=' or before a quote the value may stand on the next line, after a plain ':' only on the same one.
SECRET = re.compile(
    r"(?i)(?:" + "|".join(SECRET_WORDS) + r""")(?:[_-][\w-]{0,40})?\\?["'`]?[ \t\r\n]*(?:(?::=|=>|==?)[ \t\r\n]*|:[ \t]*|:[ \t\r\n]*(?=\\?["'`]))"""
    r"""(?:"([^"\n]+)"|'([^'\n]+)'|`([^`\n]+)`|“([^”\n]+)”|\\"(.+?)\\"|[\\]?["'`“]?([^\s"'`“\\]\S*))"""
)
AFTER_SECRET = ".,;:!?)]}>\"'`”\\"
SECRET_WINDOW = 1 << 13
# Words between a form of address and a name, or between names.
TITLES = set("dr prof mr mrs ms miss herr herrn frau madame monsieur mme sr sra señor señora doña г-н г-жа".split())
PARTICLES = set("van von vom zu zum zur de del della der den dem di da do dos das du des la le las los el al bin ibn ben y e af av ten ter st".split())
PHONE = re.compile(
    r"(?<![\w.+])(?:\+\d(?:[ ()./-]{0,2}\d){6,14}|\(\+?\d{1,5}\)(?:[ ./-]{0,2}\d){4,12}|0\d(?:[ ()./-]{0,2}\d){5,13})(?!\d)"
    r"|(?<![\w.,/+-])(?P<groups>\d{1,4}(?:[ .-]\d{2,8}){1,5})(?!\w|[.,/-]\d)"
)
_YEAR = r"(?:1[5-9]|20)\d\d"
NO_PHONE = re.compile(
    rf"{_YEAR}([ .-])(?:0?[1-9]|1[0-2])\1(?:[0-2]?\d|3[01])(?!\d)|(?:[0-2]?\d|3[01])([ .-])(?:[0-2]?\d|3[01])\2{_YEAR}(?!\d)"
    rf"|{_YEAR}(?:[ .-]{_YEAR})+$|{_YEAR} \d+$|\d{{1,2}}(?: \d{{3}})+$|\d{{1,3}}(?:\.\d{{3}})+$|\d+\.\d+$|\d+(?: \d\d)+$"
)
FINDERS = [
    ("secret", SECRET),
    ("email", re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")),
    ("key", re.compile(r"\bA[KS]IA[0-9A-Z]{16}\b")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w.]*\d)")),
    ("card", re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]*\d)")),
    ("phone", PHONE),
    ("phone", re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3}[ .-]\d{3,4}(?!\d)|(?<![\w.])\+\d{8,14}(?!\d)")),
]
LETTERS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")
KIND_COUNTS = "n_entities int, kinds array<string>"


def luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10


def script_of(word: str) -> str:
    first = ord(word[0])
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 else "latin"


@lru_cache(1 << 16)
def letters_like(c: str) -> str:
    """The characters of the same category (letter case, digit) in this one's block of 64."""
    start, category = ord(c) & ~63, unicodedata.category(c)
    return "".join(x for x in map(chr, range(start, start + 64)) if unicodedata.category(x) == category)


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The normal form of the replacement for the entity with this normal form."""
    seed, counter, pool = f"{kind}\0{value}\0{attempt}".encode(), 0, 0

    def draw(n: int) -> int:
        nonlocal counter, pool
        if counter % 4 == 0:
            pool = int.from_bytes(hashlib.blake2b(seed + counter.to_bytes(4, "big"), key=key, digest_size=32).digest(), "big")
        counter += 1
        pool, out = divmod(pool, n)
        return out

    def like(text: str) -> str:
        out = []
        for i, c in enumerate(text):
            for letters in LETTERS:
                if c in letters:
                    c = letters[draw(len(letters))] if letters is not LETTERS[2] or c == "0" or i else str(1 + draw(9))
                    break
            else:
                if c.isalpha() or c.isdecimal():
                    like_c = LETTERS[c.isupper()] if ord(c) < 0x250 and c.isalpha() else letters_like(c)
                    c = like_c[draw(len(like_c))]
            out.append(c)
        return "".join(out)

    def wider(text: str, letters: str) -> str:
        """``like``, longer from the third draw on; at once if nothing of the text can be replaced."""
        fixed = not any(c.isalpha() or c.isdecimal() for c in text)
        return like(text) + "".join(letters[draw(len(letters))] for _ in range(max(more, attempt + 1 if fixed else 0)))

    more = max(0, attempt - 2)

    if kind.startswith("name"):
        _, gender, script = kind.split(":")
        onsets, vowels, ends = SYLLABLES[script]
        middle = "".join(onsets[draw(len(onsets))] + vowels[draw(len(vowels))] for _ in range(2 + draw(2) + more))
        return middle + onsets[draw(len(onsets))] * (gender == "f") + ends[gender][draw(len(ends[gender]))]
    if kind == "email":
        local, _, domain = value.partition("@")
        name, _, top = domain.rpartition(".")
        host = surrogate("domain", name, key, 0)  # addresses of one domain stay together
        return f"{wider(local, LETTERS[0] + LETTERS[2])}@{host}.{top}"
    if kind == "ip":
        a, b = value.split(".")[:2]
        rest = [str(256 + draw(99 * more) if more else 1 + draw(254)) for _ in range(4)]
        head = [a] if a in ("10", "127") else [a, b] if (a, b) == ("192", "168") else [str(11 + draw(116))]
        return ".".join(head + rest[len(head):])
    if kind == "card":
        body = value[0] + "".join(str(draw(10)) for _ in range(len(value) - 2 + more))
        last = (10 - luhn(body + "0")) % 10
        return body + str((last + (luhn(value) and 1 + draw(9))) % 10)
    if kind == "phone":
        zeros = len(value) - len(value.lstrip("0"))
        return value[:zeros] + wider(value[zeros:], LETTERS[2])
    return value[:4] + wider(value[4:], LETTERS[1] + LETTERS[2]) if kind == "key" else wider(value, LETTERS[0] + LETTERS[2])


def normal_form(kind: str, text: str) -> str:
    if kind in ("card", "phone"):
        return re.sub(r"\D", "", text)
    return text.lower() if kind == "email" or kind.startswith("name") else text


def dressed(kind: str, text: str, new: str) -> str:
    """The surrogate's normal form in the format of the text that it replaces."""
    if kind in ("card", "phone"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in text) + "".join(digits)
    if kind.startswith("name"):
        return new.upper() if text.isupper() and len(text) > 1 else new.capitalize() if text[0].isupper() else new
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(text, new)) if len(text) == len(new) else new
    return new


_ADDRESS = sorted(ADDRESS)


def is_phone(text: str, grouped: bool) -> bool:
    return 7 <= sum(c.isdigit() for c in text) <= 15 and not (grouped and NO_PHONE.match(text))


def snippets(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Per text the byte ranges in which an entity can lie: words with a digit, @ or =, or a form of address, and their neighbours;
    a secret with its key word and sign."""
    words = A.find_words(data, bounds)
    if not len(words.start):
        return
    marks = np.concatenate(([0], np.cumsum(A.DIGIT[data] | (data == 64) | (data == 61))))
    hit = marks[words.end] > marks[words.start]
    low = A.lower_latin(data)
    hashes = A.span_hash(low.astype(A.U64) + A.U64(1), words.start, words.end, A.BYTE_BASE)
    named = np.isin(hashes, _ADDRESS_HASHES)
    near = hit.copy()
    for k in (1, 2):
        near[k:] |= hit[:-k] | named[:-k]
        near[:-k] |= hit[k:]
    near |= named
    near[3:] |= named[:-3]
    reach = 0
    for k in np.flatnonzero(named).tolist():  # all names after a form of address
        stop = int(words.first[np.searchsorted(words.first, k, "right")])
        reach = max(reach, k + 1)
        while reach < stop and _may_be_name(data[words.start[reach] : min(words.end[reach], words.start[reach] + 64)].tobytes()):
            near[reach] = True
            reach += 1
    for first, last in _secret_spans(low, bounds):
        near[np.searchsorted(words.end, first, "right") : np.searchsorted(words.start, last)] = True
    at = np.flatnonzero(near)
    rows = words.rows()
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(at) > 1) | (np.diff(rows[at]) > 0), [True]))) if len(at) else np.zeros(0, int)
    for a, e in zip(cut[:-1], cut[1:]):
        first, last = at[a], at[e - 1]
        yield int(rows[first]), int(words.start[first]), int(words.end[last])


def _secret_spans(low: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges from the key word of a secret to its end, in lower-cased texts."""
    raw = low.tobytes()
    for word in SECRET_WORDS:
        mark, at = word.encode(), raw.find(word.encode())
        while at >= 0:
            stop = int(bounds[np.searchsorted(bounds, at, "right")])
            if _SECRET_SIGN.match(raw, at + len(mark), stop):
                m = SECRET.match(raw[at : min(stop, at + SECRET_WINDOW)].decode("utf-8", "replace"))
                if m:
                    yield at, at + len(m[0].encode())
            at = raw.find(mark, at + len(mark))


def _address_hashes() -> np.ndarray:
    out = []
    for word in _ADDRESS:
        raw = np.frombuffer(word.encode(), np.uint8)
        out.append(A.span_hash(raw.astype(A.U64) + A.U64(1), np.array([0]), np.array([len(raw)]), A.BYTE_BASE)[0])
    return np.array(out, A.U64)


_ADDRESS_HASHES = _address_hashes()
_FORM = re.compile(r"(?<!\S)(" + "|".join(re.escape(w) for w in sorted(_ADDRESS, key=len, reverse=True)) + r")(?=\s)", re.I)
_NEXT = re.compile(r"\s+([^\W\d_][\w'’-]*)(\.?)")
_NAME = re.compile(r"(?<!\w)[^\W\d_][\w'’-]*")
_OWNER = re.compile(r"(?:['’][sS])?['’-]*$")


def _may_be_name(word: bytes) -> bool:
    text = word.decode("utf-8", "ignore")
    return text[:1].isupper() or text.rstrip(".").lower() in PARTICLES or text.rstrip(".").lower() in TITLES


def names_after(text: str, at: int, shouted: bool) -> list[tuple[int, int]]:
    """Bounds of the names from ``at`` on, where a form of address ends."""
    names: list[tuple[int, int]] = []
    while (m := _NEXT.match(text, at)) and not (shouted and len(names) == 2):
        word, at = m[1], m.end()
        low = word.lower()
        if low in TITLES:
            if names:
                break
        elif word[0].isupper() and not (low == "st" and m[2]):
            end = _OWNER.search(word).start()
            names.append((m.start(1), m.start(1) + end))
            if end < len(word) or m[2] and len(word) > 1:
                break
        elif low not in PARTICLES:
            break
    return names




def entities(text: str) -> list[tuple[int, int, str]]:
    """Bounds and kinds of the entities of a piece of text, in order and apart; earlier finders win."""
    found: list[tuple[int, int, str]] = []

    def add(start: int, end: int, kind: str) -> None:
        if all(end <= a or start >= e for a, e, _ in found):
            found.append((start, end, kind))

    for kind, pattern in FINDERS:
        if pattern is PHONE:
            masked = list(text)
            for a, e, _ in found:
                masked[a:e] = "x" * (e - a)
            text = "".join(masked)
        for m in pattern.finditer(text):
            start, end = m.span(m.lastindex or 0 if kind == "secret" else 0)
            if kind == "secret":
                end = start + (len(m[m.lastindex].rstrip(AFTER_SECRET)) or end - start) if m.lastindex == SECRET.groups else end
            if pattern is not PHONE or is_phone(m[0], m["groups"] is not None):
                add(start, end, kind)
    for m in _FORM.finditer(text):
        gender = ADDRESS[m[1].lower()]
        names = names_after(text, m.end(), m[1].isupper() and len(m[1].rstrip(".")) > 1)
        for start, end in names[:-1]:
            add(start, end, f"name:{gender}:{script_of(text[start])}")
        for start, end in names[-1:]:
            add(start, end, f"name:u:{script_of(text[start])}")
    return sorted(found)


def _mentions(text: str, names: dict[str, str]) -> Iterator[tuple[int, int, str]]:
    """Bounds and kinds of the words of a text that are these names, capitalised."""
    for m in _NAME.finditer(text):
        whole = m[0][: _OWNER.search(m[0]).start()]
        parts = [(0, whole)] if whole.lower() in names or "-" not in whole else [(p.start(), p[0]) for p in re.finditer("[^-]+", whole)]
        for a, part in parts:
            kind = names.get(part.lower())
            if kind and part[0].isupper():
                yield m.start() + a, m.start() + a + len(part), kind


def _scan(data: np.ndarray, bounds: np.ndarray, mentions: bool = True) -> Iterator[tuple[int, int, int, str, str]]:
    """Text, byte bounds, kind and spelling of the entities of a chunk; further mentions of a text's names have a kind of the name's first one."""
    def found() -> Iterator[tuple[int, int, int, str, str]]:
        for row, start, end in snippets(data, bounds):
            piece = data[start:end].tobytes().decode("utf-8", "replace")
            for a, e, kind in entities(piece):
                s = start + len(piece[:a].encode())
                yield row, s, s + len(piece[a:e].encode()), kind, piece[a:e]

    for row, group in groupby(found(), lambda x: x[0]):
        rows = list(group)
        names: dict[str, str] = {}
        for *_, kind, text in rows:
            if kind.startswith("name") and len(text) > 1:
                names.setdefault(normal_form(kind, text), kind)
        if mentions and names:
            own, k, at, s = rows, 0, 0, int(bounds[row])
            rows = list(own)
            text = data[bounds[row] : bounds[row + 1]].tobytes().decode("utf-8", "replace")
            for a, e, kind in _mentions(text, names):
                s += len(text[at:a].encode())
                at, end = a, s + len(text[a:e].encode())
                while k < len(own) and own[k][2] <= s:
                    k += 1
                if k == len(own) or own[k][1] >= end:
                    rows.append((row, s, end, kind, text[a:e]))
            rows.sort()
        yield from rows


def _distinct(docs: DataFrame) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for _, data, bounds in A.chunks(batch):
                seen.update((kind, normal_form(kind, text)) for _, _, _, kind, text in _scan(data, bounds, mentions=False))
            rows = list(zip(*sorted(seen))) if seen else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.string()) for r in rows], ["kind", "value"])

    return docs.select("text").mapInArrow(scan, "kind string, value string").distinct()


def redrawn(docs: DataFrame, key: bytes) -> DataFrame:
    """Rows ``kind, value, attempt, as_kind`` of the entities whose first surrogate collides, or whose name has another gender elsewhere."""
    def draws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(k, v, key, a) for k, v, a in zip(*(c.to_pylist() for c in batch.columns))]
            yield batch.append_column("new", pa.array(new, pa.string()))

    schema = "kind string, value string, attempt int, new string"
    named, parts = F.col("kind").startswith("name"), F.split("kind", ":")
    script = F.when(named, parts[2])
    each = _distinct(docs).groupBy("value", F.when(named, "name").otherwise(F.col("kind")).alias("type"), script.alias("script")).agg(
        F.collect_set("kind").alias("kinds"), F.array_remove(F.collect_set(F.when(named, parts[1])), "u").alias("genders")
    )
    gender = F.when(F.size("genders") == 1, F.col("genders")[0]).otherwise("u")
    kind = F.when(F.col("script").isNull(), F.col("type")).otherwise(F.concat_ws(":", "type", gender, "script"))
    each = written(each.select(kind.alias("kind"), "value", "kinds"), "entities")
    all_ = each.select("kind", "value")
    space = F.when(F.col("kind").startswith("name"), "name").otherwise(F.col("kind"))
    originals = all_.select(space.alias("space"), F.col("value").alias("new")).distinct()
    state = written(all_.select("kind", "value", F.lit(0).alias("attempt")).mapInArrow(draws, schema), "draws")
    for attempt in count(1):
        spaced = state.withColumn("space", space)
        first = W.partitionBy("space", "new").orderBy("attempt", "kind", "value")
        marked = spaced.withColumn("rank", F.row_number().over(first)).join(originals.withColumn("real", F.lit(True)), ["space", "new"], "left")
        marked = written(marked.withColumn("bad", (F.col("rank") > 1) | F.col("real").isNotNull()).select("kind", "value", "attempt", "new", "bad"), "draws")
        if marked.where("bad").isEmpty():
            break
        again = marked.where("bad").select("kind", "value", F.lit(attempt).alias("attempt")).mapInArrow(draws, schema)
        state = marked.where("NOT bad").drop("bad").unionByName(again)
    drawn = each.where("kinds != array(kind)").select("kind", "value", F.lit(0).alias("attempt")).unionByName(state.where("attempt > 0").select("kind", "value", "attempt"))
    drawn = drawn.groupBy("kind", "value").agg(F.max("attempt").alias("attempt"))
    return each.join(drawn, ["kind", "value"]).select(F.explode("kinds").alias("seen"), "value", "attempt", F.col("kind").alias("as_kind")).withColumnRenamed("seen", "kind")


def with_surrogates(docs: DataFrame, key: bytes = b"surrogates") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and ``n_entities`` and ``kinds`` of what was."""
    docs = docs.drop("n_entities", "kinds", "_again")
    again = written(redrawn(docs, key), "redrawn")
    columns = docs.columns
    place = columns.index("text")
    schema = docs.withColumns({"n_entities": F.lit(None).cast("int"), "kinds": F.lit(None).cast("array<string>")}).schema
    held = None
    if fits_broadcast(again, 16 << 20):
        held = docs.sparkSession.sparkContext.broadcast({(r[0], r[1]): (r[3], r[2]) for r in again.collect()})
    else:
        kind = {"key": F.xxhash64("text")}

        def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, bounds in A.chunks(batch):
                    of = part.column(0).to_pylist()
                    rows = sorted({(of[r], k, normal_form(k, t)) for r, _, _, k, t in _scan(data, bounds, mentions=False)})
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["key", "kind", "value"])

        found = docs.select(F.xxhash64("text").alias("key"), "text").mapInArrow(mentions, "key long, kind string, value string").distinct()
        found = found.join(again, ["kind", "value"]).groupBy("key").agg(F.collect_list(F.struct("kind", "value", "attempt", "as_kind")).alias("_again"))
        docs = docs.withColumns(kind).join(found, "key", "left").select(*columns, "_again")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                own = part.column(len(columns)).to_pylist() if held is None else None
                texts = [data[a:e].tobytes() for a, e in zip(bounds[:-1], bounds[1:])]
                kinds: list[list[str]] = [[] for _ in texts]
                pieces: dict[int, list] = {}
                for row, s, e, kind, text in _scan(data, bounds):
                    value = normal_form(kind, text)
                    attempts = held.value if held is not None else {(x["kind"], x["value"]): (x["as_kind"], x["attempt"]) for x in own[row] or []}
                    as_kind, attempt = attempts.get((kind, value), (kind, 0))
                    new = dressed(kind, text, surrogate(as_kind, value, key, attempt))
                    pieces.setdefault(row, []).append((s - int(bounds[row]), e - int(bounds[row]), new.encode()))
                    kinds[row].append(kind.split(":")[0])
                for row, parts in pieces.items():
                    out, at = [], 0
                    for s, e, new in parts:
                        out += [texts[row][at:s], new]
                        at = e
                    texts[row] = b"".join([*out, texts[row][at:]])
                null = part.column(place).is_null()
                new_text = pa.array(texts, pa.binary(), mask=null.to_numpy(zero_copy_only=False)).cast(pa.string())
                arrays = [new_text if i == place else part.column(i) for i in range(len(columns))]
                arrays += [pa.array([len(k) for k in kinds], pa.int32()), pa.array([sorted(set(k)) for k in kinds], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, "n_entities", "kinds"])

    return docs.mapInArrow(replace, schema)
