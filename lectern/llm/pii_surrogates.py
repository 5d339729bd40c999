"""PII surrogates: detected entities get keyed replacements of their own type, gender, script and format.

A replacement is a function of the key, the entity's type and its normal form, so one entity has one surrogate in the whole
corpus (coreference). Distinctness is checked over the table of distinct entities: where two entities of a type meet in
one surrogate, or a surrogate is itself an entity of the corpus, all but the first draw again, until none is left. Only
those few entities are handed to the rewriting pass, per document; all others follow from the key alone.

Types: e-mail addresses, telephone numbers (international, and the usual national forms), IPv4 addresses, payment cards (Luhn),
IBANs (check number), secrets (assigned tokens), names after a title and all mentions of these names in the same document as
capitalised words by themselves. Formats are kept: digits stay digits and separators stay where they are, a card keeps its first digit, its length
and a right check digit, an IBAN its country and a right check number, a telephone its country code or leading zero, an address four
numbers below 256, letters their case and script, a name the gender its title tells.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import aside, bounded, table, written

KEY = "change-me"
#: Attempts that keep an entity's length.
WIDEN = 3

#: Titles and the gender they tell (n: neither).
TITLES = {"Mr": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Sr": "m", "Señor": "m", "Sir": "m", "г-н": "m", "Κος": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Mme": "f", "Madame": "f", "Mlle": "f", "Sra": "f", "Señora": "f",
          "г-жа": "f", "Κα": "f", "Dr": "n", "Prof": "n"}
_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
#: A name word by itself, and the ending of an owner.
_ALONE, _OWNER = re.compile(r"(?<!\w)" + _WORD + r"(?!\w)"), re.compile("['’]s$")
_PATTERNS = [  # (cheap test, pattern); earlier ones win where two meet
    (lambda t: "@" in t, re.compile(
        r"(?P<email>(?<![A-Za-z0-9])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![A-Za-z0-9]))")),
    (lambda t: '"' in t or "'" in t, re.compile(
        r"(?i:\b(?:token|secret|api[_-]?key|passw(?:or)?d)\s{0,2}[=:]\s{0,2}[\"'])(?P<secret>[A-Za-z0-9_+/=-]{16,})(?=[\"'])")),
    (re.compile(r"\d").search, re.compile(
        r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]?\d{3,4}(?!\d))"
        r"|(?P<card>(?<![\w.])\d(?:[ -]?\d){12,}(?!\w))|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)(?![A-Za-z]))")),
    (re.compile(r"\d{3}").search, re.compile(
        r"(?P<national>(?<![\w+.(-])(?:\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}(?P<sep>[.-])\d{3}(?P=sep)\d{4}|0\d{2,4}[ -]\d{3,4}[ -]?\d{3,4})(?!\w|[ .-]\d))")),
    (re.compile(r"[A-Z]{2}\d\d").search, re.compile(
        r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))")),
    (lambda t: any(x in t for x in TITLES), re.compile(
        r"\b(?P<title>" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\.?[ \u00a0](?P<name>" + _WORD + "(?: " + _WORD + ")?)")),
]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _remainder(iban: str) -> int:
    """The remainder by 97 of an IBAN, of which country and check number count last and letters as 10 to 35; 1 is right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(m: re.Match) -> list[tuple[int, int, str, str]]:
    """The longest IBAN that a match begins with; groups behind it may be words in capitals."""
    text = m.group("iban")
    for end in [len(text), *(i for i in range(len(text) - 1, 14, -1) if text[i] == " ")]:
        bare = text[:end].replace(" ", "")
        if 15 <= len(bare) <= 34 and _remainder(bare) == 1:
            return [(m.start("iban"), m.start("iban") + end, "iban", bare)]
    return []


def _is_card(d: str) -> bool:
    two, four = int(d[:2]), int(d[:4])
    known = (d[0] == "4" and len(d) in (13, 16, 19)) or (len(d) == 16 and (51 <= two <= 55 or 2221 <= four <= 2720 or four == 6011 or two == 65)) or (len(d) == 15 and two in (34, 37))
    return known and luhn(d)


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, normal form) of every entity, in order. A candidate that fails its type's test (check digit,
    numbers above 255, a name in lower case) is ordinary text. Given and family names are entities of their own, so a
    person keeps the family name whether or not the given name is there; a name by itself after a title is a family name.
    A name found so is an entity wherever else it stands in the text as a capitalised word, with the type it was first found with."""
    out = []
    for may, pattern in _PATTERNS if text else ():
        for m in pattern.finditer(text) if may(text) else ():
            kind = "national" if m.groupdict().get("national") else m.lastgroup
            if kind in ("email", "secret"):
                out.append((m.start(kind), m.end(kind), kind, m.group(kind).lower() if kind == "email" else m.group(kind)))
            elif kind == "phone":
                out.append((m.start(), m.end(), kind, re.sub(r"\D", "", m.group())))
            elif kind == "national":
                out.append((m.start(), m.end(), "phone", re.sub(r"\D", "", m.group())))
            elif kind == "iban":
                out += _iban(m)
            elif kind == "ip" and all(int(x) < 256 for x in m.group().split(".")):
                out.append((m.start(), m.end(), kind, ".".join(str(int(x)) for x in m.group().split("."))))
            elif kind == "card":
                out += _cards(m)
            elif kind == "name":
                words = [_OWNER.sub("", w) for w in m.group("name").split(" ")]
                at, gender = m.start("name"), TITLES[m.group("title")]
                if words[0][:1].isupper():
                    if len(words) == 2 and words[1][:1].isupper() and " " == text[at + len(words[0])]:
                        out.append((at, at + len(words[0]), "given", gender + ":" + words[0].casefold()))
                        at, words = at + len(words[0]) + 1, words[1:]
                    out.append((at, at + len(words[0]), "family", words[0].casefold()))
    kept, end = [], 0
    for e in sorted(out, key=lambda e: e[:2]):
        if e[0] >= end:
            kept.append(e)
            end = e[1]
    names = {}
    for _, _, kind, normal in kept:
        if kind in ("given", "family"):
            names.setdefault(normal.rpartition(":")[2], (kind, normal))
    return _with_mentions(text, kept, names) if names else kept


def _with_mentions(text: str, kept: list, names: dict) -> list[tuple[int, int, str, str]]:
    """The entities and, between them, every other capitalised word that is one of the names."""
    starts, out = [e[0] for e in kept], []
    for m in _ALONE.finditer(text):
        word = _OWNER.sub("", m.group())
        if not word[:1].isupper() or word.casefold() not in names:
            continue
        at = bisect.bisect_right(starts, m.start())
        end = m.start() + len(word)
        if (at == 0 or kept[at - 1][1] <= m.start()) and (at == len(kept) or end <= starts[at]):
            out.append((m.start(), end, *names[word.casefold()]))
    return sorted([*kept, *out])


def _cards(m: re.Match) -> list[tuple[int, int, str, str]]:
    """A run of digit groups may hold several numbers: take the longest card from each group on."""
    spans = [(g.start(), g.end()) for g in re.finditer(r"\d+", m.group())]
    k, out = 0, []
    while k < len(spans):
        for last in range(len(spans) - 1, k - 1, -1):
            piece = m.group()[spans[k][0]:spans[last][1]]
            digits = re.sub(r"\D", "", piece)
            if 13 <= len(digits) <= 19 and _is_card(digits):
                out.append((m.start() + spans[k][0], m.start() + spans[last][1], "card", digits))
                k = last
                break
        k += 1
    return out


def _digits(key: str, *parts):
    """An endless keyed stream of numbers below 2^32."""
    n = 0
    while True:
        block = hmac.new(key.encode(), "\x1f".join([*map(str, parts), str(n)]).encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        for i in range(0, 32, 4):
            yield int.from_bytes(block[i:i + 4], "big")
        n += 1


_SYLLABLES = {  # by script: (syllables, feminine endings, masculine endings)
    "latin": (["al", "be", "cor", "da", "el", "fin", "ga", "ha", "is", "jo", "ka", "lu", "mar", "ne", "or", "pa", "ro", "sa", "ti", "va"], ["a", "ina", "ia"], ["us", "an", "er"]),
    "cyrillic": (["ал", "бо", "ва", "га", "де", "зо", "ил", "ка", "ла", "ми", "но", "ол", "пе", "ро", "са", "та"], ["а", "ина", "ия"], ["ан", "ей", "ор"]),
    "greek": (["αλ", "βα", "γε", "δη", "ελ", "ζω", "κα", "λα", "μα", "νι", "ορ", "πα", "ρο", "σα", "τι", "φι"], ["α", "ια", "η"], ["ος", "ης", "ας"]),
}


def _script(word: str) -> str:
    return "cyrillic" if re.search("[\u0400-\u04ff]", word) else "greek" if re.search("[\u0370-\u03ff]", word) else "latin"


def surrogate(kind: str, normal: str, attempt: int, key: str) -> str:
    """The replacement's normal form. Attempts of one entity are independent draws; from attempt ``WIDEN`` on they grow longer than the
    entity, so a format that is full of entities does not run out (an IP address becomes one of the IPv6 range for documents)."""
    draw = _digits(key, kind, normal, attempt)
    more = max(0, attempt - WIDEN + 1)
    if kind == "card":
        body = normal[0] + "".join(str(next(draw) % 10) for _ in range(len(normal) - 2 + more))
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "phone":
        head = normal[:len(normal) - 10] if len(normal) > 10 else "0" if normal[0] == "0" else ""
        return head + "".join(str(next(draw) % (8 if k == 0 else 10) + (2 if k == 0 else 0)) for k in range(len(normal) - len(head) + more))
    if kind == "iban":
        body = "".join(str(next(draw) % 10) if c.isdigit() else chr(65 + next(draw) % 26) for c in normal[4:])
        body += "".join(str(next(draw) % 10) for _ in range(min(more, 34 - len(normal))))
        return normal[:2] + f"{98 - _remainder(normal[:2] + '00' + body):02d}" + body
    if kind == "ip" and more:
        return "2001:db8::" + ":".join(f"{next(draw) % 65535 + 1:x}" for _ in range(4))
    if kind == "ip":
        return ".".join(str(next(draw) % (223 if k == 0 else 256) + (k == 0)) for k in range(4))
    if kind in ("given", "family"):
        gender, _, word = normal.rpartition(":")
        parts, fem, masc = _SYLLABLES[_script(word)]
        ends = {"f": fem, "m": masc, "n": fem + masc}[gender] if gender else [""]
        stem = "".join(parts[next(draw) % len(parts)] for _ in range(3 + attempt // 2))
        return (gender + ":" if gender else "") + stem + ends[next(draw) % len(ends)]
    hexed = kind == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", normal)
    digits = "0123456789ABCDEF" if normal.upper() == normal else "0123456789abcdef"
    local, _, domain = normal.partition("@")

    def swap(s: str) -> str:
        one = lambda c: (digits[next(draw) % 16] if hexed else str(next(draw) % 10) if c.isdigit()
                         else chr((97 if c >= "a" else 65) + next(draw) % 26))
        return "".join(one(c) if c.isascii() and c.isalnum() else c for c in s)
    if kind == "email":  # the last label, which says what sort of address it is, stays
        head, dot, top = domain.rpartition(".")
        return swap(local + "a" * more) + "@" + swap(head) + dot + top
    return swap(normal + normal[-1:] * more)


def dressed(kind: str, old: str, new: str) -> str:
    """The replacement in the clothes of the text it replaces: separators, and upper or lower case."""
    if kind in ("card", "phone", "iban"):
        it = iter(new)
        return "".join(next(it) if c.isalnum() else c for c in old) + "".join(it)
    if kind in ("given", "family"):
        word = new.rpartition(":")[2]
        return word.upper() if old.isupper() and len(old) > 1 else word[:1].upper() + word[1:]
    if kind == "email" and old.upper() == old and old.lower() != old:
        return new.upper()
    return new


def replace_entities(text: str | None, key: str, redrawn: dict) -> tuple[str | None, int]:
    """The text with surrogates, and how many there are."""
    out, at, n = [], 0, 0
    for lo, hi, kind, normal in entities(text):
        out += [text[at:lo], dressed(kind, text[lo:hi], surrogate(kind, normal, redrawn.get((kind, normal), 0), key))]
        at, n = hi, n + 1
    return ("".join(out) + text[at:], n) if n else (text, 0)


def _found(frames):
    for f in frames:
        rows = [(d, h, kind, normal) for d, h, t in zip(f["doc_id"], f["text_hash"], f["text"]) for kind, normal in dict.fromkeys((k, v) for _, _, k, v in entities(t))]
        yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "kind", "normal"])


def redraws(entity: DataFrame, key: str) -> DataFrame:
    """(kind, normal, attempt) of the entities that may not keep attempt 0, from the distinct entities (kind, normal).

    Each round drafts surrogates for the entities still open and settles those whose surrogate no settled entity has, that
    comes first among the open ones with that surrogate, and that is no entity itself.
    """
    draft = F.pandas_udf(lambda k, v, a: pd.Series([surrogate(*x, key) for x in zip(k, v, a)]), "string")
    todo = entity.withColumn("attempt", F.lit(0))
    settled, late, round_ = None, None, 0
    while True:
        now = written(todo.withColumn("new", draft("kind", "normal", "attempt")), "drafts")
        taken = entity.select("kind", F.col("normal").alias("new"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "new"))
        best = now.groupBy("kind", "new").agg(F.min("normal").alias("_best")).join(taken, ["kind", "new"], "left_anti")
        ok = written(now.join(best, ["kind", "new"]).filter(F.col("normal") == F.col("_best")).select("kind", "normal", "attempt", "new"), "settled")
        settled = ok if settled is None else settled.unionByName(ok)
        if round_:
            late = ok if late is None else late.unionByName(ok)
        todo = written(now.join(ok, ["kind", "normal"], "left_anti").select("kind", "normal", (F.col("attempt") + 1).alias("attempt")), "open")
        if todo.isEmpty():
            break
        round_ += 1
    return (late if late is not None else ok.limit(0)).select("kind", "normal", "attempt")


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``; all other columns unchanged (one of that name is replaced).

    Null texts stay null, texts without entities are returned as they are, repeated rows all stay and are treated alike. The
    result depends on the key and on the set of entities in ``docs``. Long texts are whole; an empty table gives an empty one.
    """
    docs, back = aside(docs)
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").filter("text is not null")
    found = written(named.mapInPandas(_found, "doc_id string, text_hash long, kind string, normal string"), "entities")
    late = written(redraws(written(found.select("kind", "normal").distinct(), "distinct-entities"), key), "redraws")
    rows = docs.drop("n_entities").withColumn("_h", F.xxhash64("text"))
    if late.isEmpty():
        rows = rows.withColumn("_late", F.lit(None).cast("array<struct<kind:string,normal:string,attempt:int>>"))
    else:
        per = found.join(bounded(late), ["kind", "normal"]).groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).agg(
            F.collect_set(F.struct("kind", "normal", "attempt")).alias("_late"))
        per = bounded(written(per, "redrawn-documents"))
        rows = rows.join(per, F.col("doc_id").cast("string").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_t")), "left").drop("_d", "_t")

    @F.pandas_udf("struct<text:string,n_entities:int>")
    def rewrite(text: pd.Series, late: pd.Series) -> pd.DataFrame:
        out = [replace_entities(t, key, {(x["kind"], x["normal"]): x["attempt"] for x in some} if some is not None else {}) for t, some in zip(text, late)]
        return pd.DataFrame(out, columns=["text", "n_entities"])

    rows = rows.withColumn("_new", rewrite("text", "_late"))
    keep = [F.col("_new.text").alias("text") if c == "text" else F.col(c) for c in docs.columns if c != "n_entities"]
    return back(rows.select(*keep, F.col("_new.n_entities").alias("n_entities")))


def q_op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their entities replaced."""
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
