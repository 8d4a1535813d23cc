"""Personal data replaced by keyed surrogates, native.

Found: e-mail and IPv4 addresses, phone and card numbers, social security numbers, account numbers
(IBAN) and names after a form of address. Each distinct entity (kind and canonical form, so that
spellings of one entity stay one: coreference) gets a surrogate derived from a secret key:

* numbers keep their punctuation and length, country code or issuer digit, and check digit;
* e-mail addresses keep the pattern of letters and digits; the host is one under ``.example``;
* names keep their gender (from the form of address) and script (Latin or Cyrillic); given name and
  surname are entities of their own, so "Mr. A B" and "Mr. B" keep the surname in common.

Surrogates are checked: none equals a real entity of the table, and no two entities share one.
Those that do are derived anew with the next attempt number, until none is left.

Defined cases: null or empty text stays as it is; null ids are ids; repeated rows get the same
text; a table without entities is returned as it is; other columns are kept. Texts are read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import settled

MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Госпожа")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}\p{Ll}+(?:[-']\p{Lu}\p{Ll}+)?"
_TITLE = "(?:" + "|".join((*MALE, *FEMALE)) + r")\.?"

#: In this order; the first that matches at a place counts.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9][A-Za-z0-9-]{0,62}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\d-])"
             r"|(?<![\d.-])\+\d{8,15}(?!\d)",
    "person": rf"(?<!\p{{L}}){_TITLE} {_NAME}(?: {_NAME}){{0,2}}",
}
COMBINED = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every entity has an @, two digits with at most a blank, hyphen or dot between them, or a form of
#: address: texts without are done with one look.
HINT = r"@|\d[ .-]?\d|" + _TITLE + r" \p{Lu}"
_KINDS = (*PATTERNS, "given_m", "given_f", "surname")

_LATIN = "ba be bi bo da de di do fa fe ga go ha he ja jo ka ke la le li lo ma me mi mo na ne no pa pe ra re ri ro sa se si ta te va ve vi".split()
_CYRILLIC = "ба бе би бо ва ве ви во га го да де ди до жа за зе ка ке ко ла ле ли ло ма ме ми мо на не но па пе ра ре ри ро са се та те".split()
_ENDS = {
    ("given_m", False): "n,r,s,l,d,k".split(","), ("given_m", True): "н,р,с,л,д,к".split(","),
    ("given_f", False): "na,la,ne,lle,ra,sa".split(","), ("given_f", True): "на,ла,ня,ра,са,да".split(","),
    ("surname", False): "nner,rst,lsen,rdt,ckett,ldo".split(","), ("surname", True): "нко,рук,лян,рец,дзе,кин".split(","),
}


def _digit(hexes: Column, i: Column | int, base: int) -> Column:
    """A number below ``base`` from the i-th pair of hex digits."""
    at = (i if isinstance(i, Column) else F.lit(i)) * 2 + 1
    return F.pmod(F.conv(F.substring(hexes, at, F.lit(2)), 16, 10).cast("int"), F.lit(base))


def _hashed(key: str, *parts: Column) -> Column:
    """A keyed hash of 128 hex digits (the key stands outside and inside)."""
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 512)
    return F.sha2(F.concat(F.lit(key), inner), 512)


def _each_char(value: Column, make) -> Column:
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, make), "")


def _scrambled(value: Column, hexes: Column) -> Column:
    """Digits become keyed digits, letters keyed letters of the same case, the rest stays."""
    lower = "abcdefghijklmnopqrstuvwxyz"

    def one(c: Column, i: Column) -> Column:
        pick = lambda letters: F.substring(F.lit(letters), _digit(hexes, i, len(letters)) + 1, F.lit(1))
        return (F.when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[a-z]"), pick(lower))
                .when(c.rlike("[A-Z]"), pick(lower.upper())).otherwise(c))

    return _each_char(value, one)


def _luhn_sum(digits: Column) -> Column:
    """Sum of the check digit rule over a digit string whose last digit is doubled first."""
    values = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: F.when(
        i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _check_digit(body: Column) -> Column:
    return F.pmod(F.lit(10) - F.pmod(_luhn_sum(body), F.lit(10)), F.lit(10)).cast("string")


def _pick(options, number: Column) -> Column:
    return F.get(F.array(*map(F.lit, options)), number)


def _name(kind: str, value: Column, hexes: Column, attempt: Column) -> Column:
    """Two syllables and an ending; more syllables from the third attempt on."""
    def spell(syllables, ends):
        n = F.lit(2) + F.when(attempt >= 3, F.least(attempt - 2, F.lit(20))).otherwise(0)
        parts = F.transform(F.sequence(F.lit(1), n), lambda i: _pick(syllables, _digit(hexes, i, len(syllables))))
        return F.concat(F.array_join(parts, ""), _pick(ends, _digit(hexes, 0, len(ends))))
    latin, cyrillic = spell(_LATIN, _ENDS[kind, False]), spell(_CYRILLIC, _ENDS[kind, True])
    return F.when(value.rlike(r"\p{IsCyrillic}"), cyrillic).otherwise(latin)


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical entity, canonical itself."""
    h = _hashed(key, kind, value, attempt.cast("string"))
    host = _hashed(key, F.lit("host"), F.substring_index(value, "@", -1))
    email = F.concat(
        _scrambled(F.substring_index(value, "@", 1), h),
        F.when(attempt >= 3, F.substring(h, 100, 12)).otherwise(""),
        F.lit("@"), _pick("mail post mx inbox".split(), _digit(host, 20, 4)), F.substring(host, 1, 8), F.lit(".example"))
    octets = F.concat_ws(".", *((F.pmod(_digit(h, i, 256), F.lit(223)) + 1 if i == 0 else _digit(h, i, 256)).cast("string") for i in range(4)))
    digits = _scrambled(value, h)
    body = F.concat(F.substring(value, 1, 1), F.expr("''"), F.substring(digits, F.lit(2), F.length(value) - 2))
    own_body = F.substring(value, F.lit(1), F.length(value) - 1)
    valid = _check_digit(own_body) == F.substring(value, -1, 1)
    card = F.concat(body, F.when(valid, _check_digit(body)).otherwise(F.substring(digits, -1, 1)))
    iban = F.concat(F.substring(value, 1, 2), F.substring(digits, F.lit(3), F.length(value)))
    country = F.regexp_extract(value, r"^\+(\d*)/", 1)
    rest = F.regexp_extract(value, r"(\d+)$", 1)
    phone = F.concat(F.when(value.startswith("+"), F.concat(F.lit("+"), country, F.lit("/"))).otherwise(""), _scrambled(rest, h))
    return (
        F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "card", card)
        .when(kind == "iban", iban).when(kind == "ssn", digits).when(kind == "phone", phone)
        .when(kind == "given_m", _name("given_m", value, h, attempt)).when(kind == "given_f", _name("given_f", value, h, attempt))
        .when(kind == "surname", _name("surname", value, h, attempt)))


def _kind_of(found: Column) -> Column:
    out = None
    for kind, pattern in PATTERNS.items():
        hit = found.rlike(f"^(?:{pattern})$")
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def _tokens(found: Column) -> Column:
    return F.split(found, " ")


def _parts(found: Column, kind: Column) -> Column:
    """The entities in a match: array of (kind, canonical value). A phone number's country code is
    set apart ("+1/5550100"), as it stays."""
    bare = F.regexp_replace(found, r"[^0-9+]", "")
    code = F.regexp_extract(found, r"^\+(\d{1,3})[ .(-]", 1)
    phone = F.when(found.startswith("+"), F.concat(
        F.lit("+"), code, F.lit("/"), F.substring(bare, F.length(code) + 2, F.length(bare)))).otherwise(bare)
    value = (F.when(kind == "email", F.lower(found)).when(kind.isin("card", "ssn"), F.regexp_replace(found, r"\D", ""))
             .when(kind == "iban", F.regexp_replace(found, " ", "")).when(kind == "phone", phone).otherwise(found))
    tokens = _tokens(found)
    title = F.regexp_replace(F.get(tokens, F.lit(0)), r"\.", "")
    given = F.when(title.isin(*MALE), "given_m").otherwise("given_f")
    names = F.transform(F.slice(tokens, 2, F.size(tokens)), lambda t, i: F.struct(
        F.when(i == F.size(tokens) - 2, "surname").otherwise(given).alias("kind"), F.lower(t).alias("value")))
    one = F.array(F.struct(kind.alias("kind"), value.alias("value")))
    return F.when(kind == "person", names).otherwise(one)


def _slots(found: Column, chars: Column, slot: str) -> Column:
    """``found`` with the places that match ``slot`` filled with ``chars`` in turn."""
    gaps = F.split(found, slot, -1)
    return F.array_join(F.zip_with(gaps, F.split(chars, ""), lambda g, c: F.concat(g, F.coalesce(c, F.lit("")))), "")


def _rendered(found: Column, kind: Column, made: Column) -> Column:
    """The surrogates ``made`` for the entities of a match, in the match's own format."""
    first = F.get(made, F.lit(0))
    upper = found == F.upper(found)
    title = F.get(_tokens(found), F.lit(0))
    names = F.concat_ws(" ", F.concat(F.array(title), F.transform(made, lambda m: F.initcap(m))))
    return (
        F.when(kind == "email", F.when(upper & found.rlike("[A-Z]"), F.upper(first)).otherwise(first))
        .when(kind.isin("card", "ssn"), _slots(found, first, r"\d"))
        .when(kind == "phone", _slots(found, F.regexp_replace(first, r"\D", ""), r"\d"))
        .when(kind == "iban", _slots(found, first, "[A-Z0-9]"))
        .when(kind == "person", names).otherwise(first))


def assign_surrogates(entities: DataFrame, key: str, max_rounds: int = 50) -> DataFrame:
    """(kind, value) distinct entities → with ``surrogate``: distinct within a kind and none of
    the entities. The table is read again only while some are left to be derived anew."""
    def derived(df):
        return df.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))

    table = settled(derived(entities.withColumn("attempt", F.lit(0))))
    real = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("_real"))
    for _ in range(max_rounds):
        owner = table.groupBy("kind", "surrogate").agg(
            F.count(F.lit(1)).alias("_n"), F.min(F.struct("attempt", "value")).alias("_owner"))
        bad = owner.join(real, ["kind", "surrogate"], "left").filter((F.col("_n") > 1) | F.col("_real"))
        if bad.isEmpty():
            return table.drop("attempt")
        again = table.join(bad, ["kind", "surrogate"], "left").withColumn(
            "attempt", F.col("attempt") + F.when(
                F.col("_n").isNotNull() & (F.coalesce("_real", F.lit(False)) | (F.col("_owner.value") != F.col("value"))),
                1).otherwise(0))
        table = settled(derived(again.select("kind", "value", "attempt")))
    raise ValueError(f"no distinct surrogates after {max_rounds} rounds")


def replaced(docs: DataFrame, key: str, *, text: str = "text") -> DataFrame:
    """``row``: the struct of a row of ``docs`` (with doc_id and text) with surrogates in place of
    all entities; ``kinds``: the kinds of its entities in order."""
    rows = docs.select(F.struct("*").alias("row"))
    value = F.col("row")[text]
    hit = F.coalesce(value.rlike(HINT) & value.rlike(COMBINED), F.lit(False))
    clean = rows.filter(~hit).withColumn("kinds", F.array().cast("array<string>"))
    some = rows.filter(hit).withColumn("mark", F.xxhash64(value))
    found = some.select(
        F.col("row.doc_id").alias("id"), "mark",
        F.posexplode(F.regexp_extract_all(value, F.lit(COMBINED), F.lit(0))).alias("i", "found"))
    found = found.withColumn("kind", _kind_of(F.col("found")))
    found = settled(found.withColumn("parts", _parts(F.col("found"), F.col("kind"))))
    parts = found.select("found", "kind", F.posexplode("parts").alias("p", "part")).select(
        "found", F.col("kind").alias("of"), "p", "part.kind", "part.value").distinct()
    made = assign_surrogates(settled(parts.select("kind", "value").distinct()), key)
    # A row for each distinct match: copies of a document don't multiply the work.
    rendered = settled(parts.join(made, ["kind", "value"]).groupBy("found", "of").agg(
        F.array_sort(F.collect_list(F.struct("p", "surrogate"))).alias("made")
    ).select("found", _rendered(F.col("found"), F.col("of"), F.col("made.surrogate")).alias("new")))
    per_doc = found.select("id", "mark", "i", "found", "kind").join(rendered, "found").groupBy("id", "mark").agg(
        F.array_sort(F.collect_set(F.struct("i", "new", "kind"))).alias("all"))
    per_doc = per_doc.select("id", F.col("mark").alias("of"), "all")
    joined = some.join(per_doc, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of")))
    gaps = F.split(value, COMBINED, -1)
    new = F.array_join(F.zip_with(gaps, F.col("all.new"), lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")
    changed = joined.select(F.col("row").withField(text, new).alias("row"), F.col("all.kind").alias("kinds"))
    return changed.unionByName(clean)


def replace_entities(docs: DataFrame, key: str, *, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in place of all entities."""
    return replaced(docs, key, text=text).select("row.*")
