"""Surrogates for personal data: detected entities get keyed replacements of the same type and format.

The same entity gets the same surrogate in every document (coreference) and no two entities of a type share
one (distinctness). Given names and surnames are entities of their own, so a person keeps the surname with and
without the given name. Numbers go through a keyed permutation of their digits' value range, letters through a
keyed stream; names keep gender and script. All distinct entities are checked in Spark: those that share a
surrogate, all but the first, and those whose surrogate is a real entity of the table get another try, until
none is left.

Detection takes time in proportion to a text's length, unbroken runs of any length included.
"""

from __future__ import annotations

import hmac
import re
import sys
import unicodedata

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .arrow import append_columns, free_name

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "secret", "iban", "card", "ip", "ssn", "phone", "name")
#: A name is replaced by its parts; it is counted by the surname.
_COUNTED = {"surname": "name"}
#: Entities with a further try that one broadcast holds; more are looked up in further passes.
BLOCK_RETRIES = 200_000

# Forms of address by gender, and first names to choose from by script and gender.
_FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora", "госпожа", "κυρία"]
_MALE = ["Mr", "Herr", "Monsieur", "Sr", "Señor", "господин", "κύριος"]
_FIRST = {
    ("latin", "f"): ["Ada", "Clara", "Elena", "Ines", "Laura", "Marta", "Nora", "Vera"],
    ("latin", "m"): ["Adam", "Bruno", "David", "Emil", "Felix", "Hugo", "Martin", "Oscar"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Иван", "Лев", "Олег", "Павел"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ζωή", "Θάλεια", "Ιρις", "Μαρία", "Νίκη", "Σοφία"],
    ("greek", "m"): ["Αλέξης", "Γιώργος", "Δήμος", "Ηλίας", "Θωμάς", "Λεωνίδας", "Νίκος", "Πέτρος"],
}
_ENDINGS = {
    ("latin", "f"): "a", ("latin", "m"): "o", ("cyrillic", "f"): "а", ("cyrillic", "m"): "ий", ("greek", "f"): "α", ("greek", "m"): "ος",
}
_SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "hal", "kin", "lo", "mar", "nes", "pol", "ran", "sti", "tor", "ul", "ves", "win"],
    "cyrillic": ["ба", "ве", "гор", "дан", "жин", "зо", "кам", "лев", "ман", "нов", "пет", "рос", "сам", "тин", "ул", "шан"],
    "greek": ["αν", "βα", "γε", "δη", "ζω", "θε", "καλ", "λο", "μαν", "νικ", "πα", "ρου", "στα", "τσι", "φω", "χα"],
}

_TITLES = "|".join(sorted(map(re.escape, _FEMALE + _MALE), key=len, reverse=True))
_ENTITY = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]++@[\w-]++(?:\.[\w-]++)+)"  # begins where its run of characters does
    r"|(?P<lead>\b(?i:token|api[_-]?key|secret|password|passwd)\b[\"']?\s*[=:]\s*[\"']?)(?P<secret>[A-Za-z0-9_+/=-]{8,})"
    r"|(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\w|\.\w))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<![\w+-])(?:[0-9][ -]?){12,18}[0-9](?![\w-]))"
    r"|(?P<phone>(?<!\w)(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?!\w))"
    rf"|(?P<title>\b(?:{_TITLES})\.?\s)(?P<name>[^\W\d_a-zа-яα-ω][^\W\d_]+(?: [^\W\d_a-zа-яα-ω][^\W\d_]+)?)"
)
# What every entity has: an at sign, a digit, a word for a secret or a form of address.
_LIKELY = re.compile(rf"[@0-9]|(?i:token|key|secret|passw)|\b(?:{_TITLES})\b")


def _gender(title: str) -> str:
    return "f" if title.strip(" .\n\t") in _FEMALE else "m"


def find(text: str) -> list[tuple[str, str, int, int]]:
    """(kind, key, start, end) of the entities of a text, in order. The key has what makes an entity the same
    wherever it stands: digits without separators for numbers, lower case for addresses."""
    if not _LIKELY.search(text):
        return []
    found = []
    for m in _ENTITY.finditer(text):
        kind = m.lastgroup
        value, start, end = m[kind], m.start(kind), m.end(kind)
        if kind == "email":
            key = value.lower()
        elif kind in ("secret", "ip"):
            key = value
        elif kind == "name":
            given, _, last = value.rpartition(" ")
            if given:
                found.append(("given", f"{_gender(m['title'])}:{given}", start, start + len(given)))
            kind, key, start = "surname", last, end - len(last)
        else:
            key = re.sub(r"[^0-9A-Z+]", "", value)
        found.append((kind, key, start, end))
    return found


def _number(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.digest(key, "\0".join(map(str, parts)).encode(), "sha256"), "big")


def permute(key: bytes, label: str, value: int, size: int) -> int:
    """A keyed permutation of 0..size-1: a Feistel network over the next even power of two, walked until the
    result lies in the range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for i in range(6):
            left, right = right, left ^ (_number(key, label, half, i, right) & mask)
        value = left << half | right
        if value < size:
            return value


def _digits(key: bytes, label: str, digits: str) -> str:
    return str(permute(key, f"{label}:{len(digits)}", int(digits), 10 ** len(digits))).zfill(len(digits)) if digits else ""


def _luhn(digits: str) -> int:
    """The check digit for some digits."""
    total = sum(d if i % 2 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def _letters(key: bytes, label: str, value: str) -> str:
    """Letters and digits by others of the same sort; everything else stays."""
    n, out = _number(key, label, value), []
    own, hexadecimal = n, re.fullmatch("[0-9a-f]+", value)
    for i, c in enumerate(value):
        if i % 24 == 23:
            n = _number(key, label, own, i)
        sort = "0123456789" if c.isdigit() else "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz" if c.isalpha() else c
        n, k = divmod(n, len(sort))
        out.append(sort[k].upper() if c.isupper() else sort[k])
    return "".join(out)


def _remainder_97(value: str) -> int:
    """The number that an account number's characters spell, letters as 10 to 35, modulo 97."""
    return int("".join(str(int(c, 36)) for c in value)) % 97


def script_of(value: str) -> str | None:
    """The script of a name, if there are names of it to choose from."""
    scripts = {"greek": "[Ͱ-Ͽἀ-῿]", "cyrillic": "[Ѐ-ӿ]", "latin": "[A-Za-zÀ-ɏ]"}
    return next((s for s, letters in scripts.items() if re.search(letters, value)), None)


def _same_block(key: bytes, label: str, name: str) -> str:
    """A name in a script without a list: its letters by others of the same kind from the same 128 characters."""
    own, out = _number(key, label, name), []
    for i, c in enumerate(name):
        first = ord(c) & ~127
        like = [x for x in map(chr, range(first, first + 128)) if unicodedata.category(x) == unicodedata.category(c)]
        out.append(like[_number(key, label, own, i) % len(like)] if c.isalpha() else c)
    return "".join(out)


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The replacement of an entity's key, of its type and format."""
    label = f"{kind}/{attempt}"
    if kind == "email":
        local, _, domain = entity.partition("@")
        more = str(_number(key, label, entity) % 10**6) if attempt > 3 else ""  # short forms may run out
        return f"{_letters(key, label + domain, local)}{more}@{_letters(key, kind, domain.rpartition('.')[0])}.example"
    if kind == "secret":
        return _letters(key, label, entity) + (_letters(key, label, "x" * 8) if attempt > 3 else "")
    if kind == "iban":
        country, body = entity[:2], _letters(key, label, entity[4:])
        if _remainder_97(entity[4:] + entity[:4]) == 1:
            return f"{country}{98 - _remainder_97(body + country + '00'):02d}{body}"
        return country + _letters(key, label, entity[2:4]) + body
    if kind == "ip":
        value = 0
        for octet in entity.split("."):
            value = value << 8 | int(octet)
        value = permute(key, label, value, 1 << 32)
        return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if kind == "card":
        if _luhn(entity[:-1]) == int(entity[-1]):
            body = entity[0] + _digits(key, label, entity[1:-1])
            return body + str(_luhn(body))
        return entity[0] + _digits(key, label, entity[1:])
    if kind == "ssn":
        return _digits(key, label, entity)
    if kind == "phone":
        own = len(entity) - 10 if entity.startswith("+") and len(entity) > 10 else 0
        return entity[:own] + _digits(key, label + entity[:own], entity[own:].lstrip("+"))
    gender, _, name = entity.rpartition(":")
    n, script = _number(key, label, entity), script_of(name)
    if not script:
        return _same_block(key, label, name)
    if gender and attempt == 0:
        names = _FIRST[script, gender]
        made = names[n % len(names)]
    else:  # the given names of the list run out
        parts = []
        for _ in range(3 if attempt < 4 else 8):
            n, k = divmod(n, 16)
            parts.append(_SYLLABLES[script][k])
        made = "".join(parts).capitalize() + (_ENDINGS[script, gender] if gender else "")
    return made.upper() if name.isupper() else made


def in_format(value: str, made: str) -> str:
    """The characters of a made number in the layout of the text it replaces."""
    rest = iter(re.sub(r"[^0-9A-Z+]", "", made))
    return "".join(next(rest, "") if re.match(r"[0-9A-Z+]", c) else c for c in value)


def _entities(docs: DataFrame) -> DataFrame:
    """``kind, entity``: the distinct entities of all texts; a task sends each of its own once at a time."""
    def run(batches):
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            fresh = {(k, e) for t in batch.column("text").to_pylist() if t for k, e, _, _ in find(t)} - seen
            if len(seen) > 500_000:
                seen.clear()
            seen |= fresh
            kinds, keys = zip(*sorted(fresh)) if fresh else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(keys, pa.string())], ["kind", "entity"])

    return docs.select("text").mapInArrow(run, "kind string, entity string").distinct()


def assign_surrogates(docs: DataFrame, key: bytes) -> tuple[DataFrame, DataFrame]:
    """``kind, entity, attempt, made`` of all entities, and the part of it with ``attempt`` above 0.

    A round tries anew those that share a surrogate, but for the one that sorts first, and those whose surrogate
    is an entity of the table, their own included. Rounds are tables in the shared folder.
    """
    def making(batch):
        columns = (batch.column(c).to_pylist() for c in ("kind", "entity", "attempt"))
        return ([surrogate(key, k, e, a) for k, e, a in zip(*columns)],)

    # What has neither letter nor digit has nothing to hide and no other form.
    real = _entities(docs).where(F.col("entity").rlike(r"[\p{L}0-9]")).select("kind", F.regexp_replace("entity", "^[fm]:", "").alias("made"))
    real = materialize(real.distinct(), "surrogates-real")
    now = materialize(append_columns(_entities(docs).withColumn("attempt", F.lit(0)), "made string", lambda: making), "surrogates")
    while True:
        first = now.groupBy("kind", "made").agg(F.min("entity").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = now.join(first, ["kind", "made"]).where("entity != first").select("kind", "entity")
        again = materialize(shared.unionAll(now.join(real, ["kind", "made"], "left_semi").select("kind", "entity")).distinct().withColumn("again", F.lit(1)), "surrogates-again")
        if again.isEmpty():
            return now, now.where("attempt > 0")
        tried = now.join(again, ["kind", "entity"], "left")
        tried = tried.select("kind", "entity", (F.col("attempt") + F.coalesce("again", F.lit(0))).cast("int").alias("attempt"))
        now = materialize(append_columns(tried, "made string", lambda: making), "surrogates")


def _blocks(rows: DataFrame, size: int):
    held = {}
    for kind, entity, attempt in rows.select("kind", "entity", "attempt").toLocalIterator():
        held[kind, entity] = attempt
        if len(held) >= size:
            yield held
            held = {}
    if held:
        yield held


def replace_entities(docs: DataFrame, key: bytes, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows with surrogates in their texts, and ``n_<kind>``: how many of each kind were replaced.

    A null text stays null and has none; an empty one stays empty; repeated rows come out alike. A surrogate
    depends on the key and, where two entities would share one, on the entities of this table. Existing
    columns of the new names are replaced, no others. Texts are not shuffled; only distinct entities are. A very
    long text is read whole, in time in proportion to its length; a long secret is one entity.
    """
    sc = docs.sparkSession.sparkContext
    _, retried = assign_surrogates(docs.select(F.col(text).alias("text")), key)
    tried = free_name(docs, "_tries")
    df = docs.withColumn(tried, F.lit(None).cast("array<string>"))

    def looking_up(held):
        def make():
            known = held.value

            def fn(batch):
                tries = batch.column(tried).to_pylist()
                for i, value in enumerate(batch.column(text).to_pylist()):
                    own = {f"{known[k, e]}\0{k}\0{e}" for k, e, _, _ in find(value or "") if (k, e) in known}
                    tries[i] = sorted({*(tries[i] or ()), *own}) or None
                return (tries,)

            return fn

        return make

    for block in _blocks(retried, BLOCK_RETRIES):
        df = append_columns(df, f"{tried} array<string>", looking_up(sc.broadcast(block)))

    def replacing():
        def fn(batch):
            texts, counts = [], {k: [] for k in KINDS}
            for value, tries in zip(batch.column(text).to_pylist(), batch.column(tried).to_pylist()):
                found = find(value) if value else []
                attempts = {tuple(x.split("\0", 2)[1:]): int(x.split("\0", 2)[0]) for x in tries or ()}
                done, parts = 0, []
                for kind, entity, start, end in found:
                    made = surrogate(key, kind, entity, attempts.get((kind, entity), 0))
                    if kind in ("card", "phone", "ssn", "iban"):
                        made = in_format(value[start:end], made)
                    parts += [value[done:start], made]
                    done = end
                texts.append(value if not parts else "".join(parts) + value[done:])
                kinds = [_COUNTED.get(k, k) for k, _, _, _ in found]
                for k, column in counts.items():
                    column.append(kinds.count(k))
            return texts, *counts.values()

        return fn

    made = f"`{text}` string, " + ", ".join(f"n_{k} bigint" for k in KINDS)
    return append_columns(df, made, replacing, drop=(tried, *drop))
