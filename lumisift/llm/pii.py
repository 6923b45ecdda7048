"""Personal data: detected entities get keyed surrogates of the same type, script, format and, for names, gender.

A surrogate is a function of the key, the entity's kind and its normalised value, so all mentions of an entity anywhere
get the same one, each in its own format (case, separators). That two entities never share a surrogate, and that no
surrogate is an entity of the corpus, is checked over the distinct entities: all but one of those that collide draw
again until nothing collides. Only the entities that had to draw again are joined back to the documents.

Given names are not drawn: the key makes one cycle of each script's and gender's list, and a given name's surrogate is
the next one of it. Different given names so have different surrogates, none its own, though each is a name of the list
that the corpus may have as well.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lumisift.llm.stored import stored

KINDS = ("secret", "email", "iban", "card", "ssn", "ip", "phone", "name")
_SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?([a-z0-9+/_\-]{16,})")
_EMAIL = re.compile(r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)+")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_CARD = re.compile(r"(?<![\d.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w)")
_IP = re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)")
_DIGIT = re.compile(r"\d")

#: Given names by script and gender, and forms of address by gender.
GIVEN = {
    ("latin", "m"): "Adam Andrew Brian Carlos Daniel David Edward Frank George Hans James John Juan Karl Louis Mark Martin Michael Paul Peter Pierre Robert Stefan Thomas William".split(),
    ("latin", "f"): "Alice Anna Barbara Carmen Caroline Claire Elena Elizabeth Emma Heidi Isabel Jane Julia Karen Laura Linda Lucia Margaret Maria Marie Nancy Patricia Sarah Sophie Susan".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Борис Владимир Дмитрий Иван Михаил Николай Павел Пётр Сергей".split(),
    ("cyrillic", "f"): "Александра Анна Вера Галина Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
}
ADDRESS = {"Mr": "m", "Mr.": "m", "Mrs": "f", "Mrs.": "f", "Ms": "f", "Ms.": "f", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f", "Monsieur": "m", "Madame": "f", "Dr.": "", "Prof.": ""}
#: Syllables that surnames are made of, and the letters of each script.
SYLLABLES = {"latin": "bar bel cor dan der fal gar hol kin lan mar ner pol ras sen tal ver win".split(), "cyrillic": "бар бел вор дан гор зал кин лан мар нев пол рас сен тал".split()}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
#: A name begins with one of these as a whole run of letters, whatever stands next to it.
_STARTS = {*_GENDER, *(title.rstrip(".") for title in ADDRESS)}
_LETTERS = re.compile(r"[^\W\d_]+")
_NAME = re.compile(
    rf"\b(?:(?P<title>{'|'.join(map(re.escape, sorted(ADDRESS, key=len, reverse=True)))})\s+)?"
    rf"(?P<name>(?:(?P<given>{'|'.join(sorted(_GENDER, key=len, reverse=True))})\b(?:\s+(?P<sur>[^\W\d_]+))?)|(?P<only>[^\W\d_]+))"
)


def script_of(letter: str) -> str:
    return "cyrillic" if "Ѐ" <= letter <= "ӿ" else "greek" if "Ͱ" <= letter <= "Ͽ" else "latin"


def _luhn(digits: list[int]) -> bool:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def entities(text: str) -> list[tuple[str, str, int, int]]:
    """Kind, normalised value, start and end of the entities of a text, none overlapping; of overlapping ones the kind
    named first in `KINDS` counts."""
    found = []
    if "=" in text or ":" in text:
        found += [("secret", m.group(1).lower(), *m.span(1)) for m in _SECRET.finditer(text)]
    if "@" in text:
        found += [("email", m.group().lower(), *m.span()) for m in _EMAIL.finditer(text)]
    if _DIGIT.search(text):
        found += [("iban", v, *m.span()) for m in _IBAN.finditer(text) if _mod97(v := m.group().replace(" ", "")) == 1]
        found += [("card", re.sub(r"\D", "", m.group()), *m.span()) for m in _CARD.finditer(text)]
        found += [("ssn", m.group(), *m.span()) for m in _SSN.finditer(text)]
        found += [("phone", v, *m.span()) for m in _PHONE.finditer(text) if 7 <= len(v := re.sub(r"\D", "", m.group())) <= 15]
        found += [("ip", m.group(), *m.span()) for m in _IP.finditer(text) if all(int(x) < 256 for x in m.group().split("."))]
    if not _STARTS.isdisjoint(_LETTERS.findall(text)):
        for m in _NAME.finditer(text):
            given, sur, only = m["given"], m["sur"], m["only"]
            if given:
                sur = sur if sur and sur[0].isupper() else None
                script, gender = _GENDER[given]
                end = m.end("sur") if sur else m.end("given")
                found.append(("name", f"{script}|{gender}|{given}|{(sur or '').lower()}", m.start("given"), end))
            elif m["title"] and only and only[0].isupper():
                found.append(("name", f"{script_of(only)}|{ADDRESS[m['title']]}||{only.lower()}", m.start("only"), m.end("only")))
    found.sort(key=lambda x: (KINDS.index(x[0]), x[2]))
    taken, out = [], []
    for x in found:
        if all(x[3] <= a or x[2] >= b for a, b in taken):
            taken.append(x[2:])
            out.append(x)
    return sorted(out, key=lambda x: x[2])


class Surrogates:
    """Keyed surrogates of entities."""

    def __init__(self, key: str):
        self.key = key.encode()
        self.given: dict[str, str] = {}  # the next name of its list's cycle
        for names in GIVEN.values():
            cycle = sorted(names, key=lambda n: hmac.new(self.key, f"given\x1f{n}".encode(), hashlib.sha256).digest())
            self.given.update(zip(cycle, cycle[1:] + cycle[:1], strict=True))

    def _stream(self, *what: object) -> Iterator[int]:
        n = 0
        while True:
            yield from hmac.new(self.key, "\x1f".join(map(str, (*what, n))).encode(), hashlib.sha256).digest()
            n += 1

    def _chars(self, kind: str, value: str, attempt: int) -> list[str]:
        """What stands for each letter and digit of a value, in lower case."""
        draw = self._stream(kind, value, attempt)
        signs = [c for c in value if c.isalnum()]
        number = lambda: next(draw) << 8 | next(draw)
        out = [str(number() % 10) if c.isdigit() else (a := LETTERS[script_of(c)])[number() % len(a)] for c in signs]
        if kind == "secret" and all(c in "0123456789abcdef" for c in signs):
            out = ["0123456789abcdef"[number() % 16] for _ in signs]
        elif kind == "email":  # the top-level domain stays
            keep = sum(c.isalnum() for c in value.rpartition(".")[2])
            out[len(out) - keep :] = signs[len(signs) - keep :]
        elif kind == "card" and _luhn([int(c) for c in signs]):
            out[-1] = next(d for d in "0123456789" if _luhn([int(c) for c in [*out[:-1], d]]))
        elif kind == "iban":
            out[:2] = value[:2].lower()
            out[2:4] = f"{98 - _mod97(''.join(out[:2]) + '00' + ''.join(out[4:])):02d}"
        elif kind == "phone" and len(signs) > 10:  # the country code stays
            out[: len(signs) - 10] = signs[: len(signs) - 10]
        return out

    def of(self, kind: str, value: str, mention: str, attempt: int = 0) -> str:
        """The surrogate of an entity in the format of one of its mentions."""
        if kind == "ip":
            draw = self._stream(kind, value, attempt)
            return ".".join(str(1 + next(draw) % 254) for _ in range(4))
        if kind == "name":
            script, _, given, sur = value.split("|")
            draw = self._stream("surname", sur, attempt)
            parts = SYLLABLES.get(script, SYLLABLES["latin"])
            last = "".join(parts[next(draw) % len(parts)] for _ in range(3 + attempt // 4)).capitalize() if sur else ""
            first = self.given[given] if given else ""  # alone or with a surname, a given name has one surrogate
            return " ".join(x for x in (first, last) if x)
        put, out = iter(self._chars(kind, value, attempt)), []
        for c in mention:
            new = next(put, c) if c.isalnum() else c
            out.append(new.upper() if c.isupper() else new)
        made = "".join(out)
        return made.upper() if mention.isupper() else made

    def normal(self, kind: str, value: str, attempt: int) -> str:
        """The surrogate as a normalised value of its kind, to be compared with entities."""
        made = self.of(kind, value, value, attempt)
        if kind != "name":
            return made
        script, gender, given, _ = value.split("|")
        first, _, last = made.rpartition(" ") if " " in made else (made, "", "") if given else ("", "", made)
        return f"{script}|{gender}|{first}|{last.lower()}"


def replacements(found: DataFrame, key: str, rounds: int = 100) -> DataFrame:
    """Entities `kind, value` that do not take their first surrogate, with the number of the draw they take.

    Names without a surname are not drawn and cannot collide: their surrogates are a permutation of the list's names.
    """
    makers = Surrogates(key)

    @pandas_udf("string")
    def normal(kinds: pd.Series, values: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([makers.normal(*x) for x in zip(kinds, values, attempts, strict=True)], dtype=object)

    known = stored(found.select("kind", "value").where("not (kind = 'name' and value like '%|')").distinct().withColumn("attempt", F.lit(0)), "entities")
    drawn = stored(known.withColumn("made", normal("kind", "value", "attempt")), "drawn")
    for _ in range(rounds):
        real = known.select("kind", F.col("value").alias("made"))
        shared = drawn.groupBy("kind", "made").agg(F.min(F.struct(-F.col("attempt"), F.col("value"))).alias("first"), F.count("*").alias("n")).where("n > 1")
        lost = drawn.join(shared, ["kind", "made"]).where("value <> first.value").select("kind", "value")
        lost = stored(lost.union(drawn.join(real, ["kind", "made"], "left_semi").select("kind", "value")).distinct(), "lost")
        if not lost.limit(1).count():
            return drawn.where("attempt > 0").select("kind", "value", "attempt")
        again = drawn.join(lost.withColumn("again", F.lit(1)), ["kind", "value"], "left")
        again = again.select("kind", "value", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt"))
        drawn = stored(again.withColumn("made", normal("kind", "value", "attempt")), "drawn")
    raise RuntimeError("too few surrogates of this format")


def pseudonymised(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with surrogates in place of entities, and the number of entities of each kind: id, n_entities, n_<kind> for
    each of `KINDS`, text.

    A null text stays null and has no entities. Rows with equal ids are treated each by itself, a null id like any
    other. Other columns are left out; an empty table gives no rows.
    """
    makers = Surrogates(key)
    found_type = "array<struct<kind:string,value:string>>"

    @pandas_udf(found_type)
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({(k, v) for k, v, _, _ in entities(t)}) if t else [] for t in texts], dtype=object)

    @pandas_udf("struct<text:string,kinds:array<int>>")
    def replace(texts: pd.Series, draws: pd.Series) -> pd.DataFrame:
        out, counts = [], []
        for text, draw in zip(texts, draws, strict=True):
            own = {(d["kind"], d["value"]): d["attempt"] for d in draw} if draw is not None else {}
            found = entities(text) if text else []
            parts, at = [], 0
            for kind, value, a, b in found:
                parts += [text[at:a], makers.of(kind, value, text[a:b], own.get((kind, value), 0))]
                at = b
            out.append(None if text is None else "".join(parts) + text[at:])
            counts.append([sum(f[0] == k for f in found) for k in KINDS])
        return pd.DataFrame({"text": pd.Series(out, dtype=object), "kinds": pd.Series(counts, dtype=object)})

    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    mentions = stored(docs.select("id", F.explode(find("text")).alias("e")).select("id", "e.*"), "mentions")
    draws = replacements(mentions, key)
    draws = mentions.join(draws, ["kind", "value"]).groupBy("id").agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("draws"))  # a document's own
    made = docs.join(draws.withColumnRenamed("id", "of"), F.col("id").eqNullSafe(F.col("of")), "left").select("id", replace("text", "draws").alias("r"))
    counts = [F.col("r.kinds")[i].cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    total = F.aggregate("r.kinds", F.lit(0).cast("long"), lambda s, x: s + x)
    return made.select(F.col("id").alias(id_col), total.alias("n_entities"), *counts, F.col("r.text").alias("text"))
