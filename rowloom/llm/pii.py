"""Surrogates for personal data: keyed replacements of the same type, with checked distinctness.

Found are mail addresses, IPv4 addresses, card, phone and social security numbers, cloud access keys, values
given to a password, token, secret or key, and names after a title. A replacement depends on the secret key and on the
canonical form of the entity, so one entity has one surrogate in all documents, however it is written
(coreference). It keeps the format: digits become digits, letters letters of the same case and script, separators stay; a card number
that passes its check digit has a surrogate that does; hexadecimal stays hexadecimal; addresses stay
addresses, on a domain reserved for examples; a phone number keeps its country code, and a name becomes a name of the
gender that the title says.

Two entities of a type never share a surrogate, and no surrogate is an entity that occurs: what clashes
draws again with another salt until nothing does, each round as joins over the distinct entities. Only drawn-again
entities are joined back to the documents.

NULL texts stay NULL, empty ones empty; texts without entities are returned as they are. Repeated rows are
treated alike. An empty table gives an empty result. A column named like the count is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import fresh, let, row_key
from rowloom.sources.shared import materialize

# Patterns of entities; quantifiers that start a match cannot back up, so long texts take linear time.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Госпожа", "г-жа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Господин", "г-н"),
}
_TITLE = "|".join(t for ts in _TITLES.values() for t in ts)
_SETS = r"(?:password|passwd|token|secret|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
_ADDRESS = rf"(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9])"
#: Digits behind a country code: a phone is complete with them, and a further number is none of its groups.
_DIGITS = {"1": 10, "7": 10, "44": 10, "91": 10, "33": 9, "34": 9, "48": 9, "31": 9, "86": 11}
_SHAPES = "|".join(rf"\+{code}(?:[ .()-]{{0,2}}[0-9]){{{n}}}(?![0-9])" for code, n in _DIGITS.items())
#: Country codes of one and two digits; all others have three.
_COUNTRY = r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|3[47][0-9]{13})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": rf"(?<![0-9+])(?:{_SHAPES}|\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})(?:[ .-]?(?!{_ADDRESS})[0-9]{{2,4}}){{2,4}}|\(?[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}})(?![0-9])",
    "access_key": r"(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9])",
    "secret": rf"(?i:{_SETS})[A-Za-z0-9_/+=.-]{{8,}}",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.?\x20\p{{Lu}}\p{{Ll}}+(?:\x20\p{{Lu}}\p{{Ll}}+){{0,2}}",
}
#: Groups keep a mention's beginning (title, or what a secret is given to) apart from the rest.
_HEAD = {"secret": rf"(?i:{_SETS})", "name": rf"(?:{_TITLE})\.?\x20"}
ENTITY = "|".join(PATTERNS.values())

#: Parts of invented names.
_SYLLABLES = {
    "latin": ("ba", "de", "ki", "lo", "mu", "na", "ri", "so", "ta", "ve", "wi", "ze", "ga", "fe", "pi", "ro"),
    "cyrillic": ("ба", "де", "ки", "ло", "му", "на", "ри", "со", "та", "ве", "ви", "зе", "га", "фе", "пи", "ро"),
}
_ENDINGS = {"latin": {"f": "la", "m": "ldo", "family": "nner"}, "cyrillic": {"f": "ла", "m": "лан", "family": "нко"}}

ROUNDS = 64


def _draw(seed: Column, place: Column, n: int | Column) -> Column:
    return F.pmod(F.xxhash64(seed, place), F.lit(n) if isinstance(n, int) else n).cast("int")


def kind(mention: Column) -> Column:
    """The type of a mention: the first pattern that it matches in whole; looking around it is not needed."""
    out = None
    for name, pattern in PATTERNS.items():
        test = mention.rlike(f"^(?:{pattern})$")
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("secret")


def _head(mention: Column, kind_: Column) -> Column:
    """The part of a mention that stays."""
    return (
        F.when(kind_ == "name", F.regexp_extract(mention, f"^({_HEAD['name']})", 1))
        .when(kind_ == "secret", F.regexp_extract(mention, f"^({_HEAD['secret']})", 1))
        .otherwise("")
    )


def parts(mention: Column) -> Column:
    """The entities of a mention: (type, canonical, written), several for a name of several words."""

    def of(m: Column) -> Column:
        rest = F.substring(m["mention"], F.char_length(m["head"]) + 1, F.char_length(m["mention"]))
        digits = F.regexp_replace(rest, "[^0-9+]", "")
        canonical = (
            F.when(m["kind"] == "email", F.lower(rest)).when(m["kind"].isin("card", "ssn", "phone"), digits).otherwise(rest)
        )
        title = F.regexp_replace(m["head"], r"\.?\x20$", "")
        gender = F.when(title.isin(*_TITLES["f"]), "f").otherwise("m")
        names = F.split(rest, " ")
        each = F.transform(
            names,
            lambda x, i: F.struct(
                F.when(i == F.size(names) - 1, F.lit("name_family")).otherwise(F.concat(F.lit("name_"), gender)).alias("type"),
                F.lower(x).alias("canonical"), x.alias("written"),
            ),
        )
        single = F.array(F.struct(m["kind"].alias("type"), canonical.alias("canonical"), rest.alias("written")))
        return F.when(m["kind"] == "name", each).otherwise(single)

    def with_kind(m: Column) -> Column:
        return let(F.struct(m["mention"].alias("mention"), m["kind"].alias("kind"), _head(m["mention"], m["kind"]).alias("head")), of)

    return let(F.struct(mention.alias("mention"), kind(mention).alias("kind")), with_kind)


def _mapped(text: Column, seed: Column, hexadecimal: Column) -> Column:
    """Digits to digits, letters to letters; place by place."""

    def one(c: Column, i: Column) -> Column:
        letters = F.when(hexadecimal, 6).otherwise(26)
        return (
            F.when(c.between("0", "9"), F.chr(_draw(seed, i, 10) + 48))
            .when(c.between("a", "z"), F.chr(_draw(seed, i, letters) + 97))
            .when(c.between("A", "Z"), F.chr(_draw(seed, i, letters) + 65))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _check_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled (and its digits added up)."""
    each = F.transform(
        F.reverse(F.split(digits, "")),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _card(canonical: Column, seed: Column) -> Column:
    """Keeps the first digit, and the check digit right if it was."""
    n = F.char_length(canonical)
    body = F.concat(F.substring(canonical, 1, 1), F.substring(_mapped(canonical, seed, F.lit(False)), F.lit(2), n - 2))

    def closed(b: Column) -> Column:
        right = F.pmod(10 - _check_sum(F.concat(b, F.lit("0"))), F.lit(10))
        valid = _check_sum(canonical) % 10 == 0
        return F.concat(b, F.when(valid, right).otherwise(F.pmod(right + 1 + _draw(seed, F.lit(99), 9), F.lit(10))).cast("string"))

    return let(body, closed)


def _name(canonical: Column, type_: Column, seed: Column, salt: Column) -> Column:
    cyrillic = canonical.rlike(r"\p{IsCyrillic}")

    def made(script: str) -> Column:
        syllables = F.array(*map(F.lit, _SYLLABLES[script]))
        stem = F.array_join(
            F.transform(F.sequence(F.lit(1), F.lit(3) + F.floor(salt / 4).cast("int")), lambda i: F.get(syllables, _draw(seed, i, len(_SYLLABLES[script])))), ""
        )
        ends = _ENDINGS[script]
        return F.concat(stem, F.when(type_ == "name_family", ends["family"]).when(type_ == "name_f", ends["f"]).otherwise(ends["m"]))

    return F.when(cyrillic, made("cyrillic")).otherwise(made("latin"))


def surrogate(type_: Column, canonical: Column, salt: Column, key: str) -> Column:
    """The canonical form of an entity's replacement."""

    def drawn(seed: Column) -> Column:
        octets = [_draw(seed, F.lit(i), n) + low for i, (n, low) in enumerate(((223, 1), (256, 0), (256, 0), (256, 0)))]
        at = F.instr(canonical, "@")
        domain = F.regexp_replace(F.substring(canonical, at, F.char_length(canonical)), r"\.[^.]*$", ".example")
        mail = F.concat(
            _mapped(F.substring(canonical, F.lit(1), at - 1), seed, F.lit(False)),
            F.lit("@"),
            _mapped(F.regexp_extract(domain, r"^@(.*)\.example$", 1), F.concat(seed, F.lit("@")), F.lit(False)),
            F.lit(".example"),
        )
        country = F.regexp_extract(canonical, rf"^({_COUNTRY}|[0-9])", 1)
        phone = F.concat(country, F.substring(_mapped(canonical, seed, F.lit(False)), F.char_length(country) + 1, F.char_length(canonical)))
        return (
            F.when(type_ == "email", mail)
            .when(type_ == "ip", F.concat_ws(".", *(o.cast("string") for o in octets)))
            .when(type_ == "card", _card(canonical, seed))
            .when(type_ == "phone", phone)
            .when(type_ == "access_key", F.concat(F.lit("AKIA"), _mapped(F.substring(canonical, 5, 16), seed, F.lit(False))))
            .when(type_.startswith("name_"), _name(canonical, type_, seed, salt))
            .otherwise(_mapped(canonical, seed, canonical.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")))
        )

    return let(F.sha2(F.concat_ws("\x1f", F.lit(key), type_, canonical, salt.cast("string")), 256), drawn)


def _as_written(type_: Column, written: Column, new: Column) -> Column:
    """A canonical replacement in the format of a mention."""

    def digit_by_digit(digits: Column) -> Column:
        def step(a: Column, c: Column) -> Column:
            takes = c.rlike("[0-9+]")
            return F.struct(
                F.concat(a["text"], F.when(takes, F.substring(digits, a["n"], F.lit(1))).otherwise(c)).alias("text"),
                F.when(takes, a["n"] + 1).otherwise(a["n"]).alias("n"),
            )

        return F.aggregate(F.split(written, ""), F.struct(F.lit("").alias("text"), F.lit(1).alias("n")), step, lambda a: a["text"])

    return (
        F.when(type_.isin("card", "ssn", "phone"), let(new, digit_by_digit))
        .when(type_.startswith("name_"), F.initcap(new))
        .when((type_ == "email") & (written == F.upper(written)), F.upper(new))
        .otherwise(new)
    )


def _mentions(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({ENTITY})"), F.lit(1))


def drawn_again(entities: DataFrame, key: str) -> DataFrame:
    """Entities (type, canonical) whose first surrogate clashes: type, canonical, salt.

    A surrogate clashes if it is an entity itself or if an earlier round, or in the same round a lesser
    entity, has it.
    """
    entities = materialize(entities.select("type", "canonical").distinct(), "entities")
    taken = entities.select("type", F.col("canonical").alias("new"))
    pending, again = entities.withColumn("salt", F.lit(0)), []
    for _ in range(ROUNDS):
        drawn = materialize(pending.withColumn("new", surrogate(F.col("type"), F.col("canonical"), F.col("salt"), key)), "drawn")
        free = drawn.join(taken, ["type", "new"], "left_anti")
        won = materialize(free.groupBy("type", "new").agg(F.min(F.struct("canonical", "salt")).alias("w")).select("type", "new", "w.*"), "won")
        again.append(won.filter("salt > 0").select("type", "canonical", "salt"))
        taken = taken.unionByName(won.select("type", "new"))
        pending = drawn.join(won, ["type", "canonical"], "left_anti").select("type", "canonical", (F.col("salt") + 1).alias("salt"))
        pending = materialize(pending, "pending")
        if pending.isEmpty():
            out = again[0]
            for more in again[1:]:
                out = out.unionByName(more)
            return out
    raise ValueError("some type has too few surrogates for its entities")


def replace_entities(df: DataFrame, key: str, text: str = "text", count: str = "n_entities") -> DataFrame:
    """df with the entities of `text` replaced, and the number of replaced mentions."""
    found = df.select(F.explode(_mentions(F.col(text))).alias("mention")).distinct()
    entities = found.select(F.explode(parts(F.col("mention"))).alias("e")).select("e.type", "e.canonical")
    again = materialize(drawn_again(entities, key), "again")
    salts = fresh(df, "salts")
    if again.isEmpty():
        rows = df.withColumn(salts, F.lit(None).cast("map<string,int>"))
    else:
        own, theirs = fresh(df, "key"), fresh(df, "its_key")
        named = df.select(row_key(F.col(text)).alias(theirs), F.explode(F.array_distinct(_mentions(F.col(text)))).alias("mention")).distinct()
        per_text = (
            named.select(theirs, F.explode(parts(F.col("mention"))).alias("e"))
            .select(theirs, "e.type", "e.canonical")
            .distinct()
            .join(again, ["type", "canonical"])
            .groupBy(theirs)
            .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "type", "canonical"), "salt"))).alias(salts))
        )
        rows = df.withColumn(own, row_key(F.col(text)))
        rows = rows.join(materialize(per_text, "salts"), F.col(own) == F.col(theirs), "left").drop(own, theirs)

    def replaced(mention: Column) -> Column:
        def entity(e: Column) -> Column:
            salt = F.coalesce(F.element_at(salts, F.concat_ws("\x1f", e["type"], e["canonical"])), F.lit(0))
            return _as_written(e["type"], e["written"], surrogate(e["type"], e["canonical"], salt, key))

        head = let(F.struct(mention.alias("m"), kind(mention).alias("k")), lambda x: _head(x["m"], x["k"]))
        return F.concat(head, F.array_join(F.transform(parts(mention), entity), " "))

    def rebuilt(m: Column) -> Column:
        gaps = F.split(F.col(text), ENTITY, -1)
        return F.array_join(F.zip_with(gaps, F.transform(m, replaced), lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")

    mentions = _mentions(F.col(text))
    new = F.when(F.size(mentions) > 0, let(mentions, rebuilt)).otherwise(F.col(text))
    return rows.withColumns({text: new, count: F.size(mentions).cast("long")}).drop(salts)
