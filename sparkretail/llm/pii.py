"""PII surrogates in DataFrame operations alone.

One pattern finds e-mail addresses, phone numbers, IPv4 addresses, card
numbers (with a valid check digit), social security numbers, IBANs, secrets after a key word, access keys
and titled person names. Each is replaced by a surrogate that depends only on
the key, its kind and its canonical form, so every mention of an entity in any
document gets the same one: digits become digits, letters letters of the same
case and script, hexadecimal stays hexadecimal, separators stay, card numbers
keep a valid check digit, addresses move to reserved ranges, and names follow
the title's gender and the script. Family and given names, and the local part
and the domain of an address, have surrogates of their own, so a family name
after a title and the full name agree and so do two addresses of one domain.

1. Texts are searched once; rows with their matches are stored under a row
   number of their own.
2. The distinct entities of all mentions, with their surrogates, are one table
   (``draw``). Two entities of one kind with the same surrogate, or a surrogate
   that is itself an entity of the documents, are drawn again (``attempt`` + 1)
   until none is left. Attempts widen the surrogates (longer local parts,
   domains and names at once, more digits where a format is nearly full), so
   there is a free one; IPv4 goes on to the other reserved ranges, and more
   distinct addresses than those hold raise an error at once.
3. Surrogates are joined back to the mentions, and those to their rows.

Null texts stay null; texts without an entity stay as they are. A null doc_id,
repeated rows and extra columns, whatever their names, do not matter; columns
of ``docs`` called ``n_entities`` or ``kinds`` are replaced. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.components import stored

L, D = r"\p{L}", r"\d"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
MALE = ("Mr.", "Mister", "Herr", "Señor", "Sr.", "Monsieur", "господин", "г-н")
FEMALE = ("Mrs.", "Ms.", "Miss", "Frau", "Señora", "Sra.", "Madame", "Mme.", "госпожа", "г-жа")
NEUTRAL = ("Dr.", "Prof.")
_TITLE = "|".join(t.replace(".", r"\.?") for t in (*MALE, *FEMALE, *NEUTRAL))
# two letters at least; inner capitals, hyphens and apostrophes belong to a name, a possessive s does not
_NAME = r"\p{Lu}[\p{L}\p{M}]*+(?:(?:['’](?![sS](?![\p{L}\p{M}]))|-)[\p{L}\p{M}]++){0,4}+(?<=[\p{L}\p{M}'’\-][\p{L}\p{M}])"
_NUMBER = "|".join((  # what follows the country code, then national numbers
    r"\+\d{1,3}[ .\-]?\d{1,3}(?:[ .\-]\d{2}){3,4}", r"\+\d{1,3}[ .\-]?\(\d{1,4}\)[ .\-]?\d{3,4}(?:[ .\-]\d{2,4}){1,2}",
    r"\+\d{1,3}[ .\-]?\d{2,5}[ .\-]\d{3,4}(?:[ .\-]\d{2,4}){1,2}", r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,5})[ .\-]?\d{5,8}",
    r"\+\d{7,15}", r"\(\d{2,4}\)[ .\-]?\d{3,4}(?:[ .\-]\d{2,4}){1,2}", r"\(\d{3}\) ?\d{7}",
    r"\d{3}[ .\-]\d{3,4}(?:[ .\-]\d{2,4}){1,2}"))
PATTERNS = {
    "email": rf"(?<![{L}\d._%+\-])[{L}\d._%+\-]++@[{L}\d\-]++(?:\.[{L}\d\-]++)+",
    "secret": rf"(?i:(?<![{L}\d])(?:password|passwd|pwd|secret|token|api[_\-]?key)(?:[_\-](?:access[_\-])?key)?)[\"']?\s{{0,3}}[=:]\s{{0,3}}"
              r"(?:[\"'][^\"'\s]{8,}+|[\"']?[A-Za-z0-9_\-]{8,}+)",
    "access_key": r"(?<![A-Za-z0-9])(?i:AKIA|ASIA)[A-Za-z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv4": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": rf"(?<![{L}\d])\d{{4}}[ \-]?\d{{4}}[ \-]?\d{{4}}[ \-]?\d{{1,7}}(?![{L}\d])",
    "phone": rf"(?<![{L}\d+])(?:{_NUMBER})(?![{L}\d])",
    "person": rf"(?<![{L}])(?:{_TITLE}) (?:\p{{Lu}}\. ?){{0,3}}{_NAME}(?:(?: \p{{Lu}}\.){{0,2}} {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: every kind but names has one of these characters
SIGN = "[0-9@=:]"

#: given names of surrogates by script and gender
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Marco", "Nils",
                     "Oscar", "Paul", "Robert", "Simon"),
    ("latin", "f"): ("Ada", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Irene", "Julia", "Laura",
                     "Maria", "Nora", "Olga", "Paula", "Rosa"),
    ("cyrillic", "m"): ("Адам", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Лев", "Марк", "Олег", "Павел",
                        "Роман", "Семён", "Тимур", "Фёдор", "Юрий"),
    ("cyrillic", "f"): ("Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Лидия", "Мария", "Нина",
                        "Ольга", "Полина", "Раиса", "Софья", "Юлия"),
}
#: syllables of surrogate family names
SYLLABLES = {
    "latin": ("ba", "ber", "dan", "del", "fen", "gor", "hal", "kin", "lan", "mer", "nor", "pel", "ros", "sten", "tar", "wel"),
    "cyrillic": ("ба", "вер", "гор", "дан", "зим", "кра", "лан", "мор", "нор", "пет", "рус", "сол", "тар", "фед", "чер", "яр"),
}


def find_all(text: Column) -> Column:
    """Every match in order; an empty array where there is none."""
    none = F.array().cast("array<string>")
    maybe = text.rlike(SIGN)  # a cheap test first: most texts hold no entity
    for title in (*MALE, *FEMALE, *NEUTRAL):
        for form in {title, title.removesuffix(".")}:
            maybe = maybe | text.contains(f"{form} ")
    return F.when(maybe, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def kind_of(m: Column) -> Column:
    """The kind of a match; NULL for digits in the form of a card number whose
    check digit is wrong, which are no card number."""
    out = F.lit("phone")
    for name in ("person", "card", "ssn", "ipv4", "iban", "access_key", "secret", "email"):
        is_one = F.lit(name) if name != "card" else F.when(_luhn(F.regexp_replace(m, r"\D", "")) == 0, "card")
        out = F.when(m.rlike(f"^(?:{PATTERNS[name]})$"), is_one).otherwise(out)
    return out


#: attempts that keep the length of a number, key or address
WIDEN_AFTER = 12
_SECRET_HEAD = r"^([^=:]*[=:]\s*[\"']?)"


def canonical(kind: Column, m: Column) -> Column:
    """The form that all mentions of an entity share."""
    return (F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(m, r"\D", ""))
            .when(kind == "iban", F.regexp_replace(m, " ", ""))
            .when(kind == "secret", F.lower(F.regexp_replace(m, _SECRET_HEAD, "")))
            .when(kind == "person", _names(m))
            .otherwise(F.lower(m)))


_TITLED = rf"^((?:{_TITLE}) )"


def _names(m: Column) -> Column:
    """``gender|given names|family name`` of a titled name, lower case."""
    title = F.lower(F.regexp_extract(m, rf"^({_TITLE}) ", 1))
    is_one = lambda titles: F.rtrim(F.replace(title, F.lit("."), F.lit(""))).isin(
        [t.lower().removesuffix(".") for t in titles])
    names = F.lower(F.translate(F.regexp_replace(m, _TITLED, ""), "’", "'"))
    family = F.regexp_extract(names, "([^ .]+)$", 1)
    given = F.rtrim(F.substr(names, F.lit(1), F.length(names) - F.length(family)))
    return F.concat_ws("|", F.when(is_one(MALE), "m").when(is_one(FEMALE), "f").otherwise("n"), given, family)


def _family_of(value: Column) -> Column:
    return F.substring_index(value, "|", -1)


def _has_given(value: Column) -> Column:
    return ~value.rlike(r"^[^|]*\|\|")


def entities(kind: Column, value: Column) -> Column:
    """What surrogates are drawn for: family and given names apart, so that a
    family name alone and the full name agree, and an address's local part
    (free in its domain) and its domain."""
    one = lambda k, v: F.struct(F.lit(k).alias("kind"), v.alias("value"))
    return (F.when((kind == "person") & _has_given(value), F.array(one("family", _family_of(value)), one("given", value)))
            .when(kind == "person", F.array(one("family", _family_of(value))))
            .when(kind == "email", F.array(one("local", value), one("domain", F.substring_index(value, "@", -1))))
            .otherwise(F.array(F.struct(kind.alias("kind"), value.alias("value")))))


def assembled(kind: Column, part) -> Column:
    """The surrogate of a mention; ``part(kind)`` is that of its entity."""
    given = F.substring_index(part("given"), "|", 1)
    return (F.when(kind == "email", F.concat(F.substring_index(part("local"), "@", 1), F.lit("@"), part("domain")))
            .when(kind == "person", F.initcap(F.concat_ws(" ", given, part("family")))).otherwise(part(kind)))


def _hash(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), value)
    return F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("|more")), 512))


def _byte(h: Column, i: Column) -> Column:
    return F.conv(F.substr(h, (F.pmod(i, F.lit(128)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _scrambled(h: Column, value: Column, first: Column, hexa: Column) -> Column:
    """``value`` (lower case) with each digit and letter replaced by one of
    its class and script (hexadecimal letters by such if ``hexa``); other
    characters and the first ones stay."""
    def one(c: Column, i: Column) -> Column:
        b, p = _byte(h, i), F.ascii(c)
        put = lambda start, n: F.chr((F.lit(start) + F.pmod(b, F.lit(n))).cast("long"))
        near = lambda lo, n: F.element_at(
            F.array(*[F.lit(chr(lo + k)) for k in range(n)]), F.pmod(b, F.lit(n)) + 1)
        return (F.when(i < first, c).when(c.rlike("[0-9]"), F.pmod(b, F.lit(10)).cast("string"))
                .when(c.rlike("[a-z]"), F.when(hexa, put(97, 6)).otherwise(put(97, 26)))
                .when(p.between(0x430, 0x44F), near(0x430, 32)).when(p.between(0x3B1, 0x3C9), near(0x3B1, 17))
                .when(c.rlike(rf"{L}"), put(97, 26)).otherwise(c))

    chars = F.split(value, "")
    return F.array_join(F.transform(chars, one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, modulo 10."""
    n = F.length(digits)

    def add(acc: Column, x: Column) -> Column:
        d = x["d"].cast("int") * F.when(F.pmod(n - x["i"], F.lit(2)) == 1, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    pairs = F.transform(F.split(digits, ""), lambda c, i: F.struct(c.alias("d"), (i + 1).alias("i")))
    return F.pmod(F.aggregate(pairs, F.lit(0), add), F.lit(10))


def _checked(new: Column, value: Column) -> Column:
    """``new`` with a valid check digit if ``value`` has one."""
    body = F.substr(new, F.lit(1), F.length(new) - 1)
    check = F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn(value) == 0, F.concat(body, check)).otherwise(new)


def _pick(items: tuple[str, ...], b: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in items]), F.pmod(b, F.lit(len(items))) + 1)


def _cyrillic(value: Column) -> Column:
    return value.rlike(r"^\p{IsCyrillic}")


def _syllables(h: Column, cyrillic: Column, n: Column) -> Column:
    def join(script: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(2), n + 1), lambda i: _pick(SYLLABLES[script], _byte(h, i))), "")

    return F.when(cyrillic, join("cyrillic")).otherwise(join("latin"))


def _family(h: Column, value: Column, attempt: Column) -> Column:
    """A made-up family name of the script, one syllable longer each attempt."""
    return _syllables(h, _cyrillic(value), attempt + 4)


def _given(h: Column, value: Column, attempt: Column) -> Column:
    """A given name of the title's gender and the script, from the second
    attempt with a made-up middle name; it only has to be free in its family."""
    is_f = value.startswith("f") | (value.startswith("n") & (F.pmod(_byte(h, F.lit(0)), F.lit(2)) == 0))
    cyr = _cyrillic(F.substr(value, F.lit(3)))
    pick = lambda script: F.when(is_f, _pick(GIVEN[script, "f"], _byte(h, F.lit(1)))).otherwise(
        _pick(GIVEN[script, "m"], _byte(h, F.lit(1))))
    name = F.when(cyr, pick("cyrillic")).otherwise(pick("latin"))
    middle = F.when(attempt > 0, _syllables(h, cyr, attempt + 1))
    return F.concat(F.concat_ws(" ", F.lower(name), middle), F.lit("|"), _family_of(value))


#: reserved IPv4 ranges: first octets in bits, and the bits that are free
RESERVED = (("00001010", 24), ("101011000001", 20), ("1100000010101000", 16), ("110001100001001", 17),
            ("0110010001", 22), ("1111", 28))
RESERVED_ADDRESSES = sum(1 << bits for _, bits in RESERVED)


def _ipv4(h: Column, attempt: Column) -> Column:
    """10.0.0.0/8 at first, then each reserved range in turn."""
    bits = F.lpad(F.conv(F.substr(h, F.lit(1), F.lit(8)), 16, 2), 32, "0")
    turn = F.when(attempt < 8, 0).otherwise(F.pmod(attempt, F.lit(len(RESERVED))))
    whole = F.lit(None).cast("string")
    for i, (head, free) in enumerate(RESERVED):
        whole = F.when(turn == i, F.concat(F.lit(head), F.right(bits, F.lit(free)))).otherwise(whole)
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substr(whole, i * 8 + 1, F.lit(8)), 2, 10))
    return F.array_join(octets, ".")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The canonical surrogate of a canonical entity."""
    before, after = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    name, top = F.regexp_extract(value, r"^(.*)\.[^.]*$", 1), F.substring_index(value, ".", -1)
    longer = F.repeat(F.lit("x"), attempt)
    # formats of a fixed length are kept for some attempts, then they grow
    grown = F.repeat(F.lit("0"), F.floor(attempt / F.lit(WIDEN_AFTER)).cast("int"))
    mould = (F.when(kind == "local", F.concat(before, longer)).when(kind == "domain", F.concat(name, longer))
             .otherwise(F.concat(F.lower(value), grown)))
    hexa = ~kind.isin("local", "domain") & mould.rlike("^[0-9a-f]+$")
    first = F.when(kind == "access_key", 4).when(kind == "iban", 2).otherwise(0)

    def shaped(h: Column) -> Column:
        return _let(_scrambled(h, mould, first, hexa), lambda s: (
            F.when(kind == "local", F.concat(s, F.lit("@"), after))
            .when(kind == "domain", F.concat(s, F.lit("."), top, F.lit(".example")))
            .when(kind == "card", _checked(s, value)).when(kind == "iban", F.upper(s)).otherwise(s)))

    return _let(_hash(key, kind, value, attempt), lambda h: (
        F.when(kind == "ipv4", _ipv4(h, attempt)).when(kind == "family", _family(h, value, attempt))
        .when(kind == "given", _given(h, value, attempt)).otherwise(shaped(h))))


def poured(kind: Column, m: Column, new: Column) -> Column:
    """The surrogate in the writing of the mention: its separators, its case.
    What a widened surrogate has beyond the mention's length follows it."""
    head = (F.when(kind == "secret", F.regexp_extract(m, _SECRET_HEAD, 1))
            .when(kind == "person", F.regexp_extract(m, _TITLED, 1)).otherwise(F.lit("")))
    rest = F.substr(m, F.length(head) + 1)
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(acc: Column, c: Column) -> Column:
        alnum = c.rlike(rf"[{L}\d]")
        d = F.substr(new, acc["at"], F.lit(1))
        d = F.when(c.rlike(r"\p{Lu}"), F.upper(d)).otherwise(d)
        return F.struct(F.concat(acc["out"], F.when(alnum, d).otherwise(c)).alias("out"),
                        (acc["at"] + F.when(alnum, 1).otherwise(0)).alias("at"))

    # the canonical form has only letters and digits of these kinds
    filled = F.aggregate(F.split(rest, ""), start, put,
                         lambda acc: F.concat(acc["out"], F.substr(new, acc["at"], F.length(new))))
    signs = F.transform(F.split(rest, ""), lambda c, i: F.when(c.rlike(r"\p{Lu}"), F.upper(F.substr(new, i + 1, F.lit(1))))
                        .otherwise(F.substr(new, i + 1, F.lit(1))))
    upper = (rest == F.upper(rest)) & (rest != F.lower(rest))
    whole = F.when(upper, F.upper(new)).otherwise(new)
    return F.concat(head, F.when(kind.isin("email", "ipv4", "person"), whole)
                    .when(kind.isin("secret", "access_key"), F.concat(
                        F.array_join(signs, ""), F.substr(new, F.length(rest) + 1, F.length(new)))).otherwise(filled))


#: entities whose surrogates one task draws
DRAWN_AT_ONCE = 2048


def draw(seen: DataFrame, key: str) -> DataFrame:
    """``kind, value, new`` of the distinct entities ``kind, value`` of a
    stored table: surrogates without collisions, dealt over many tasks."""
    sizes = seen.agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "ipv4").alias("ipv4")).first()
    if sizes.ipv4 > RESERVED_ADDRESSES:
        raise ValueError(f"{sizes.ipv4} distinct IPv4 addresses, {RESERVED_ADDRESSES} reserved ones")
    drawn = surrogate(key, F.col("kind"), F.col("value"), F.col("attempt"))
    table = stored(seen.repartition(-(-sizes.n // DRAWN_AT_ONCE) or 1, "kind", "value")
                   .withColumn("attempt", F.lit(0)).withColumn("new", drawn), "surrogates")
    while True:
        # of the entities that share a surrogate the smallest keeps it; one that meets an entity of the texts never does
        first = table.groupBy("kind", "new").agg(F.min("value").alias("keeps"), F.count("*").alias("n"))
        shared = (table.join(first.where("n > 1"), ["kind", "new"]).where("value <> keeps").select("kind", "value"))
        taken = (table.join(seen.select("kind", F.col("value").alias("new")), ["kind", "new"], "left_semi")
                 .select("kind", "value"))
        again = stored(shared.union(taken).distinct(), "again")
        if again.isEmpty():
            return table.select("kind", "value", "new")
        new = (table.join(again, ["kind", "value"], "left_semi").withColumn("attempt", F.col("attempt") + 1)
               .withColumn("new", drawn))
        table = stored(table.join(again, ["kind", "value"], "left_anti").union(new.select(*table.columns)), "surrogates")


def _free(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def replace_pii(docs: DataFrame, key: str = "surrogate-key") -> DataFrame:
    """``docs`` with surrogates in ``text``, plus ``n_entities`` (mentions
    replaced) and ``kinds`` (distinct, sorted)."""
    docs = docs.drop("n_entities", "kinds")
    row, found, gaps, shown = (_free(x, docs.columns) for x in ("row_number", "found", "gaps", "shown"))
    texts = stored(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(found, find_all(F.col("text")))
                   .withColumn(gaps, F.when(F.size(found) > 0, F.split(F.col("text"), ANY, -1))), "matches")
    matches = texts.where(F.size(found) > 0).select(F.col(row).alias("row"), F.posexplode(found).alias("at", "m"))
    mentions = stored(matches.withColumn("kind", kind_of(F.col("m"))).withColumn("value", canonical(F.col("kind"), F.col("m")))
                      .where("kind is not null"), "mentions")
    parts = mentions.withColumn("e", F.explode(entities(F.col("kind"), F.col("value"))))
    table = draw(stored(parts.select("e.kind", "e.value").distinct(), "entities"), key)
    drawn = table.select(F.struct("kind", "value").alias("e"), "new")
    # the parts of a mention meet in its row's partition, and so do the row's mentions
    part = lambda kind: F.max(F.when(F.col("e.kind") == kind, F.col("new")))
    whole = (parts.select("row", "at", "m", "kind", "e").join(drawn, "e").repartition("row")
             .groupBy("row", "at", "kind", "m").agg(assembled(F.col("kind"), part).alias("new")))
    rows = (whole.select("row", "at", "kind", poured(F.col("kind"), F.col("m"), F.col("new")).alias("new"))
            .groupBy(F.col("row").alias(row)).agg(
                F.map_from_entries(F.collect_list(F.struct("at", "new"))).alias(shown), F.count("*").cast("int").alias("n_entities"),
                F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds")))
    # a match that is no entity stays
    put = F.transform(found, lambda m, i: F.coalesce(F.try_element_at(F.col(shown), i), m))
    text = F.array_join(F.flatten(F.zip_with(gaps, put, lambda g, s: F.array(g, F.coalesce(s, F.lit(""))))), "")
    changed = (texts.where(F.size(found) > 0).join(rows, row, "left").withColumn("text", text)
               .select(*docs.columns, F.coalesce("n_entities", F.lit(0)).alias("n_entities"), F.coalesce("kinds", F.lit("")).alias("kinds")))
    return changed.union(texts.where(F.size(found) == 0).select(
        *docs.columns, F.lit(0).alias("n_entities"), F.lit("").alias("kinds")))
