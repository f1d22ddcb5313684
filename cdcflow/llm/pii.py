"""Personal data replaced by keyed surrogates of the same kind and format.

Entities are found by one regular expression; card and account numbers must also pass their check digits. A surrogate
is a function of a key, the kind and the entity's canonical form, so the same entity reads alike in all documents:
letters become letters of the same case, digits digits, separators and fixed parts (country code, name of a setting, top
level domain) stay, check digits hold, a name keeps script and gender. All distinct entities are compared once: two that
would get one surrogate, or a surrogate that is itself an entity of the data, move on to a further attempt until all
differ. All of it is DataFrame functions.

The family name and each given name of a person are entities of their own, so "Mr John Smith", "Mrs Smith" and "Dr J. Smith" share
what their names share. In a text that names a person behind a form of address, the family name is replaced wherever it
stands as a word, and a given name of the text wherever it stands before such a family name. A number of the US is one entity
with and without its country code.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.session import scratch_dir

from .common import documents, free_name

_SETTING = r"(?i:(?:api[_-]?key|access[_-]?token|auth[_-]?token|token|secret|password|passwd|pwd)\s{0,2}[=:]\s{0,2}[\"']?)"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Forms of address, by script and gender.
_ADDRESS = {
    ("latin", "m"): ["Mr", "Herr", "Monsieur", "Señor", "Sr"],
    ("latin", "f"): ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra"],
    ("cyrillic", "m"): ["господин", "г-н"],
    ("cyrillic", "f"): ["госпожа", "г-жа"],
    ("latin", "n"): ["Dr", "Prof"],
}
_NAME = {
    "latin": r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?",
    "cyrillic": r"[А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?",
}
# Names for surrogates; a family name in the form of men, to which Cyrillic adds an ending for women.
_GIVEN = {
    ("latin", "m"): "Adam Albert Anton Bruno Carl David Edgar Felix Frank Georg Henry Hugo Jonas Julian Leon Lucas Marco Martin Oscar Paul Peter Robert Simon Thomas Victor".split(),
    ("latin", "f"): "Ada Alice Amelia Anna Beatrice Carla Clara Diana Elena Emma Eva Flora Helena Ida Irene Julia Laura Lucia Maria Nora Olga Paula Rosa Sofia Vera".split(),
    ("latin", "n"): "Alex Andrea Charlie Chris Dominique Jamie Kim Luca Maxime Micha Noa Robin Sacha Sam Sascha Toni".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Николай Олег Павел Роман Сергей".split(),
    ("cyrillic", "f"): "Алла Анна Вера Галина Дарья Елена Зоя Инна Кира Лидия Мария Нина Ольга Полина Софья Татьяна".split(),
}
_FAMILY = {
    "latin": "Abel Baker Becker Blanc Bond Castillo Dumont Ellis Fischer Garnier Hale Keller Lambert Marin Morel Navarro Parker Quinn Renard Romero Sanders Torres Vogel Weber Young".split(),
    "cyrillic": "Агапов Белов Волков Громов Дымов Ершов Зимин Карпов Ларин Мухин Носов Орлов Панин Рогов Седов Титов".split(),
}
_ALPHABET = {"latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"}
_SYLLABLES = {"latin": "ba de fi go lu ma ne ri so tu va we ka lo mi re".split(), "cyrillic": "ба де фи го лу ма не ри со ту ва зе ка ло ми ре".split()}


def _titles(script: str, gender: str) -> str:
    return rf"(?:{'|'.join(_ADDRESS[script, gender])})"


def _addressed(script: str, gender: str) -> str:
    """A form of address, academic ones behind it taken along."""
    more = rf"(?:{_titles('latin', 'n')}\.?\s{{1,2}})*" if script == "latin" else ""
    return rf"{_titles(script, gender)}\.?\s{{1,2}}{more}"


def _named(script: str) -> str:
    initials = rf"(?:[{_ALPHABET[script]}]\. ){{0,2}}"
    return rf"{initials}{_NAME[script]}(?: {initials}{_NAME[script]}){{0,2}}"


_PERSON = {(script, gender): _addressed(script, gender) + _named(script) for script, gender in _ADDRESS}
# Signs in a whole account number by country, after the IBAN registry and its list of partial users.
_IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_BLANK = " \u00a0\u202f"
_JOIN = f"[{_BLANK}./-]"
_PLAIN_PHONE = r"(?:\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4})"


def _iban() -> str:
    """Of a country in the table exactly its signs, so that a word behind is never taken along; of others any number."""

    def of(size: int, countries: str) -> str:
        groups, rest = divmod(size - 4, 4)
        last = rf" ?[A-Z0-9]{{{rest}}}" if rest else ""
        return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{last}"

    known = "|".join(_IBAN_SIZES.values()).replace(" ", "|")
    other = rf"(?!{known})[A-Z0-9]{{4}}(?:(?: (?!(?:{known})\d{{2}}))?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return rf"(?=[A-Z]{{2}}\d{{2}})(?:{'|'.join(of(*x) for x in _IBAN_SIZES.items())}|{other})(?!\w)"


def _phone(other: str = "") -> str:
    """Numbers with a country code have 7 to 15 digits (E.164) in any groups; without one, the forms of the US.

    Only the group behind the code, or one after a hyphen, may be a single digit. Once there are 7 digits, a blank
    before an ``other`` entity ends the number.
    """
    guard = f"(?!{other})" if other else ""
    near = rf"(?:(?:[{_BLANK}]?[/-]?[{_BLANK}]?(?=\d\d)|\.(?=\d\d)|-)?\d)"
    far = rf"(?:(?:[{_BLANK}]{guard}(?=\d\d)|[./](?=\d\d)|-)?\d)"

    def of(code: int, area: int) -> str:
        """``code`` digits and ``area`` digits in brackets, 0 for none."""
        start = rf"(?:\+\d{{{code}}}|\(\+\d{{{code}}}\)){_JOIN}?" + (rf"\(\d{{{area}}}\){_JOIN}?" if area else "")
        return rf"{start}\d{near}{{{max(6 - code - area, 0)}}}{far}{{0,{8 - max(code + area - 6, 0)}}}"

    abroad = "|".join(of(code, area) for area in range(6) for code in (3, 2, 1))
    america = rf"\+1{_JOIN}?(?:\(\d{{3}}\)|\d{{3}}){_JOIN}?\d{{3}}{_JOIN}?\d{{4}}"
    plain = rf"(?:1[.-])?(?:{_PLAIN_PHONE}|\d{{3}}\.\d{{3}}\.\d{{4}}(?!\.\d))(?![\w-])"
    return rf"(?:(?:{america}|{abroad})(?!\w|-\d)|{plain})"


KINDS = {
    "secret": rf"{_SETTING}[A-Za-z0-9/+_=-]{{8,}}",
    "key": r"(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)",
    "email": r"[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "ip": rf"{_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "iban": _iban(),
    "ssn": r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])",
    "phone": _phone(),
    "card": r"\d{4}(?:([ -]?)\d{4}\1\d{4}\1\d{1,7}|[ -]?\d{6}[ -]?\d{5})(?!\w)",
}
# What may stand behind a phone number and begin with a digit; cards without the group, so that ENTITY has only one.
_CARD_FORMS = r"\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}(?! \d{4}(?!\d))|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4}[ -]?\d{6}[ -]?\d{5}"
_BEHIND = rf"{KINDS['email']}|{KINDS['ip']}|{KINDS['ssn']}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}}(?!\d)|(?:{_CARD_FORMS})(?!\w)"
_SEARCHED = KINDS | {"phone": _phone(_BEHIND)}
# A preceding letter, digit or joining sign means the middle of something else.
ENTITY = rf"(?<![\w.%@-])(?:{'|'.join(_SEARCHED.values())}|{'|'.join(_PERSON.values())})"
# Without one of these characters or words no entity can stand in a text.
SIGN = rf"[0-9@]|{'|'.join(t for titles in _ADDRESS.values() for t in titles)}|(?i:token|secret|pass|pwd|key)"
_WORD_EDGE = r"(?<=[\p{L}\p{N}_-])(?![\p{L}\p{N}_-])|(?<![\p{L}\p{N}_-])(?=[\p{L}\p{N}_-])"
FURTHER = 8  # attempts after which digits or letters are added, so that small formats never run out
KEY = "surrogates"  # the default key; a deployment passes its own


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def _lit(items: list[str]) -> Column:
    return F.array(*(F.lit(x) for x in items))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _luhn(digits: Column, doubled: int) -> Column:
    """The check sum; ``doubled`` is 1 if the last digit is the check digit and 0 if it is still to come."""
    values = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: F.when(i % 2 == doubled, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _iban_rest(iban: Column) -> Column:
    """The number modulo 97, 1 if the check digits hold."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    values = F.transform(F.split(moved, ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)


def parsed(entity: Column) -> Column:
    """``kind, prefix, value, suffix, canonical`` of a match of ENTITY; no kind if its check digits fail."""
    e = entity

    def whole(pattern: str) -> Column:
        return e.rlike(f"^(?:{pattern})$")

    def made(kind: str, prefix: Column, value: Column, suffix: Column, canonical: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), prefix.alias("prefix"), value.alias("value"), suffix.alias("suffix"), canonical.alias("canonical"))

    none = F.lit("")
    setting = F.regexp_extract(e, f"^{_SETTING}", 0)
    secret = F.substr(e, F.length(setting) + 1)
    top = F.regexp_extract(e, r"\.[^.]*$", 0)
    address = F.substr(e, F.lit(1), F.length(e) - F.length(top))
    # Of the US the code goes with any form, also with no sign behind it.
    country = F.regexp_extract(e, rf"^(?:\(\+\d{{1,3}}\)|\+(?:1(?=\D|\d{{10}}$)|\d{{1,3}}(?=\(|{_JOIN}))|1(?=[.-]))", 0)
    dialled = F.when(e.startswith("+") | e.startswith("(+") | (country != ""), _digits(e)).otherwise(F.concat(F.lit("1"), _digits(e)))
    plain = F.regexp_replace(e, "[ -]", "")
    out = (
        F.when(whole(KINDS["secret"]), made("secret", setting, secret, none, secret))
        .when(whole(KINDS["key"]), made("key", F.substr(e, F.lit(1), F.lit(4)), F.substr(e, F.lit(5)), none, e))
        .when(whole(KINDS["email"]), made("email", none, address, top, F.lower(e)))
        .when(whole(KINDS["ip"]), made("ip", none, e, none, e))
        .when(whole(KINDS["ssn"]), made("ssn", none, e, none, _digits(e)))
        .when(whole(KINDS["iban"]) & (_iban_rest(plain) == 1), made("iban", F.substr(e, F.lit(1), F.lit(2)), F.substr(e, F.lit(3)), none, plain))
        .when(whole(KINDS["phone"]), made("phone", country, F.substr(e, F.length(country) + 1), none, dialled))
        .when(whole(KINDS["card"]) & (_luhn(_digits(e), 1) % 10 == 0), made("card", none, e, none, _digits(e)))
    )
    for (script, gender), pattern in _PERSON.items():
        title = F.regexp_extract(e, f"^{_addressed(script, gender)}", 0)
        name = F.substr(e, F.length(title) + 1)
        out = out.when(whole(pattern), made(f"person-{script}-{gender}", title, name, none, name))
    return out


def _stream(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """256 hexadecimal digits that depend on all of it."""
    parts = [F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canonical, attempt.cast("string"), F.lit(str(n))), 256) for n in range(4)]
    return F.concat(*parts)


def _number(stream: Column, at: Column) -> Column:
    return F.conv(F.substr(stream, (at % 126) * 2 + 1, F.lit(4)), 16, 10).cast("int")


def _refill(form: Column, content: Column) -> Column:
    """``form`` with its ASCII letters and digits replaced in order by ``content``, letters in their own case."""
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        new = F.substr(content, s["at"], F.lit(1))
        fitted = F.when(c.rlike("[A-Z]"), F.upper(new)).when(c.rlike("[a-z]"), F.lower(new)).otherwise(new)
        filled = c.rlike("[A-Za-z0-9]")
        return F.struct(
            F.concat(s["out"], F.when(filled, fitted).otherwise(c)).alias("out"),
            (s["at"] + F.when(filled, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(F.split(form, ""), state, step, lambda s: s["out"])


def _mixed(kind: Column, content: Column, stream: Column) -> Column:
    """Letters and digits of ``content`` replaced by others; of a hexadecimal secret by hexadecimal digits."""
    letters, digits = F.lit("abcdefghijklmnopqrstuvwxyz"), F.lit("0123456789")
    is_hex = (kind == "secret") & F.lower(content).rlike("^[0-9a-f]*[a-f][0-9a-f]*$")
    chars = F.transform(
        F.split(content, ""),
        lambda c, i: F.when(c.rlike("[0-9]"), F.substr(digits, _number(stream, i) % 10 + 1, F.lit(1)))
        .otherwise(F.substr(letters, _number(stream, i) % 26 + 1, F.lit(1))),
    )
    copies = F.repeat(stream, F.ceil(F.length(content) / 256).cast("int"))
    as_hex = F.substr(copies, F.lit(1), F.length(content))
    as_hex = F.when(content == F.upper(content), F.upper(as_hex)).otherwise(as_hex)
    return F.when(is_hex, as_hex).otherwise(F.array_join(chars, ""))


def name_parts(e: Column) -> Column:
    """The given names, initials and the family name of a ``parsed`` person, in order, as entities."""
    script, gender = (F.split_part(e["kind"], F.lit("-"), F.lit(n)) for n in (2, 3))
    none = F.lit("")

    def made(kind: Column, value: Column, suffix: Column) -> Column:
        return F.struct(kind.alias("kind"), none.alias("prefix"), value.alias("value"), suffix.alias("suffix"), value.alias("canonical"))

    def of(names: Column) -> Column:
        def part(name: Column, i: Column) -> Column:
            # A woman's family name has an ending behind the form of men.
            ending = F.when((script == "cyrillic") & (gender == "f") & name.rlike("(?:[оеё]в|[иы]н)а$"), F.lit("а")).otherwise(none)
            family = _let(ending, lambda x: made(F.concat(F.lit("family-"), script), F.substr(name, F.lit(1), F.length(name) - F.length(x)), x))
            given = made(F.concat(F.lit("given-"), script, F.lit("-"), gender), name, none)
            initial = made(F.lit("initial"), name, none)
            return F.when(name.endswith("."), initial).when(i == F.size(names) - 1, family).otherwise(given)

        return F.transform(names, part)

    return _let(F.split(e["value"], " "), of)


def _entities(e: Column) -> Column:
    """What has to stay distinct in a ``parsed`` match: the names of a person, or all of it."""
    names = F.filter(name_parts(e), lambda p: p["kind"] != "initial")
    return F.when(e["kind"].startswith("person-"), names).when(e.isNotNull(), F.array(e))


def name_surrogate(key: str, part: Column, attempt: Column) -> Column:
    """The replacement of one of ``name_parts``; initials move on in the alphabet by the key."""
    move = 1 + int(hashlib.sha256(key.encode()).hexdigest(), 16) % 25

    def made(stream: Column) -> Column:
        def out_of(names: list[str], script: str) -> Column:
            syllables = _SYLLABLES[script]
            sounds = F.transform(F.sequence(F.lit(30), attempt + 30), lambda n: F.get(_lit(syllables), _number(stream, n) % len(syllables)))
            named = F.get(_lit(names), _number(stream, F.lit(60)) % len(names))
            return F.when(attempt >= 2, F.initcap(F.array_join(sounds, ""))).otherwise(named)

        letters = "".join(_ALPHABET.values())
        moved = "".join(a[move % len(a) :] + a[: move % len(a)] for a in _ALPHABET.values())
        out = F.when(part["kind"] == "initial", F.translate(part["value"], letters, moved))
        for script, names in _FAMILY.items():
            out = out.when(part["kind"] == f"family-{script}", out_of(names, script))
        for (script, gender), names in _GIVEN.items():
            out = out.when(part["kind"] == f"given-{script}-{gender}", out_of(names, script))
        return F.concat(out, part["suffix"])

    return _let(_stream(key, part["kind"], part["canonical"], attempt), made)


def surrogate(key: str, e: Column, attempt: Column) -> Column:
    """The replacement of a ``parsed`` entity (a column or variable) that is not a person."""

    def made(stream: Column, content: Column, mixed: Column) -> Column:
        kind, value = e["kind"], e["value"]
        octets = F.concat_ws(".", *((_number(stream, F.lit(n)) % (223 if n == 0 else 254) + 1).cast("string") for n in range(4)))
        first = F.concat(F.substr(content, F.lit(1), F.lit(1)), F.substr(mixed, F.lit(2), F.length(content) - 2))
        card = _let(first, lambda f: F.concat(f, ((10 - _luhn(f, 0) % 10) % 10).cast("string")))
        bank = F.upper(F.substr(mixed, F.lit(3)))
        iban = _let(bank, lambda b: F.concat(F.lpad((98 - _iban_rest(F.concat(e["prefix"], F.lit("00"), b))).cast("string"), 2, "0"), b))
        ssn = F.concat(
            (_number(stream, F.lit(20)) % 565 + 101).cast("string"),
            F.substr((_number(stream, F.lit(21)) % 99 + 101).cast("string"), F.lit(2)),
            (_number(stream, F.lit(22)) % 9000 + 1000).cast("string"),
        )
        # Area codes and exchanges of the US begin with 2 to 9.
        lead = F.when(e["canonical"].rlike(r"^1\d{10}$") & (F.length(content) == 10), True)
        first_digits = [(_number(stream, F.lit(n)) % 8 + 2).cast("string") for n in (40, 41)]
        us = F.concat(first_digits[0], F.substr(mixed, F.lit(2), F.lit(2)), first_digits[1], F.substr(mixed, F.lit(5)))
        more = F.when(attempt >= FURTHER, F.substr(stream, F.lit(100), attempt - FURTHER + 1)).otherwise(F.lit(""))
        out = (
            F.when(kind == "ip", octets)
            .when(kind == "card", _refill(value, card))
            .when(kind == "iban", _refill(value, iban))
            .when(kind == "ssn", _refill(value, ssn))
            .when((kind == "phone") & lead, F.concat(_refill(value, us), more))
        )
        return F.concat(e["prefix"], out.otherwise(F.concat(_refill(value, mixed), more)), e["suffix"])

    plain = F.regexp_replace(F.when(e["kind"] == "email", F.lower(e["value"])).otherwise(e["value"]), "[^A-Za-z0-9]", "")
    return _let(
        _stream(key, e["kind"], e["canonical"], attempt),
        lambda s: _let(plain, lambda c: _let(_mixed(e["kind"], c, s), lambda m: made(s, c, m))),
    )


def _matches(text: str) -> Column:
    """Entities of the column ``text``; only texts with a SIGN are searched."""
    empty = F.array().cast("array<string>")
    return F.when(F.col(text).rlike(SIGN), F.regexp_extract_all(F.col(text), F.lit(ENTITY), F.lit(0))).otherwise(empty)


def retried(docs: DataFrame, key: str, rounds: int = 64) -> DataFrame | None:
    """``kind, canonical, attempt`` of the entities whose first surrogates would clash, None if there are none.

    Each round, of the entities with one surrogate the first keeps it, unless it is an entity itself; the rest try the
    next attempt. Rows are distinct entities, so a common one is one row from the first partial sum on.
    """
    spark, path = docs.sparkSession, scratch_dir(docs.sparkSession, "entities")
    found = docs.select(F.explode(F.array_distinct(_matches("text"))).alias("e")).select(parsed(F.col("e")).alias("e"))
    found = found.select(F.explode(_entities(F.col("e"))).alias("e"))
    found.groupBy("e.kind", "e.canonical").agg(F.min("e").alias("e")).write.parquet(path)
    entities = spark.read.parquet(path)
    tried = entities.withColumn("attempt", F.lit(0))
    for _ in range(rounds):
        named = F.col("kind").rlike("^(?:family|given)-")
        of_name = name_surrogate(key, F.col("e").withField("suffix", F.lit("")), F.col("attempt"))
        tried = tried.withColumn("text", F.when(named, of_name).otherwise(surrogate(key, F.col("e"), F.col("attempt"))))
        # Coreferent forms are compared by canonical form; a text that is no entity stands for itself.
        canonical = F.when(~named, parsed(F.col("text"))["canonical"])
        tried = tried.withColumn("made", F.coalesce(canonical, "text")).drop("text")
        real = entities.select("kind", F.col("canonical").alias("made"), F.lit(True).alias("real"))
        owners = tried.groupBy("kind", "made").agg(F.min(F.struct("attempt", "canonical"))["canonical"].alias("owner"), F.count("*").alias("n"))
        clashes = owners.join(real, ["kind", "made"], "left").filter("n > 1 OR real")
        if clashes.isEmpty():
            moved = tried.filter("attempt > 0").select("kind", "canonical", "attempt")
            return None if moved.isEmpty() else moved
        judged = tried.join(clashes, ["kind", "made"], "left")
        moves = F.coalesce(F.col("real") | (F.col("owner") != F.col("canonical")), F.lit(False))
        next_path = scratch_dir(spark, "entities")
        judged.select("kind", "canonical", "e", (F.col("attempt") + moves.cast("int")).alias("attempt")).write.parquet(next_path)
        tried = spark.read.parquet(next_path)
    raise RuntimeError("entities still share surrogates")


def _bare_names(part: Column, names: Column) -> Column:
    """``part`` of a text with the names of its persons replaced where they stand without a form of address."""

    def become(word: Column, of: str) -> Column:
        return F.get(F.filter(names, lambda n: (n["of"] == of) & (n["old"] == word)), 0)["new"]

    def of(words: Column) -> Column:
        def word(w: Column, i: Column) -> Column:
            # Words and what is between them take turns, so the next word is two places on.
            before_family = (F.get(words, i + 1) == " ") & become(F.get(words, i + 2), "family").isNotNull()
            given = F.when(become(w, "given").isNotNull() & before_family, become(w, "given"))
            return F.when(w.rlike(r"^\p{Lu}"), F.coalesce(become(w, "family"), given, w)).otherwise(w)

        return F.array_join(F.transform(words, word), "")

    held = F.exists(names, lambda n: (n["of"] == "family") & part.contains(n["old"]))
    return F.when(held, _let(F.split(part, _WORD_EDGE, -1), of)).otherwise(part)


def with_surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with ``text`` replaced, ``n_replaced`` and ``kinds`` (distinct, sorted, comma-joined) added.

    All other columns pass unchanged; a column of an added name is replaced. Null and empty texts stay as they are, with
    0 and ''. Rows that repeat are treated alike; an empty table gives an empty one. ``n_replaced`` counts entities with
    their form of address, not the names that stand alone. The time for a very long text grows with its length, and where it names
    persons with its words times its distinct names.
    """
    again = retried(docs, key)
    spark, columns = docs.sparkSession, docs.columns
    matches, attempts, mark = (free_name(docs, n) for n in ("_matches", "_attempts", "_mark"))
    rows = docs.withColumn(matches, _matches("text"))
    kind_of_map = "map<string,int>"
    if again is None:
        rows = rows.withColumn(attempts, F.lit(None).cast(kind_of_map))
    else:
        rows = rows.withColumn(mark, F.xxhash64("text"))
        own = (
            rows.select(F.col(mark).alias("_m"), F.explode(F.array_distinct(matches)).alias("_e"))
            .select("_m", parsed(F.col("_e")).alias("_e"))
            .select("_m", F.explode(_entities(F.col("_e"))).alias("_e"))
            .select("_m", F.col("_e.kind").alias("kind"), F.col("_e.canonical").alias("canonical"))
            .join(again, ["kind", "canonical"])
            .select("_m", F.concat_ws("\x1f", "kind", "canonical").alias("k"), "attempt")
            .distinct()
            .groupBy("_m").agg(F.map_from_entries(F.collect_list(F.struct("k", "attempt"))).alias(attempts))
        )
        path = scratch_dir(spark, "attempts")
        own.write.parquet(path)
        rows = rows.join(spark.read.parquet(path), F.col(mark) == F.col("_m"), "left").drop("_m", mark)

    def attempt_of(e: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col(attempts), F.concat_ws("\x1f", e["kind"], e["canonical"])), F.lit(0))

    def renamed(e: Column) -> Column:
        """The names of a person and what they become."""

        def of(part: Column) -> Column:
            new = _let(attempt_of(part), lambda a: name_surrogate(key, part, a))
            return F.struct(F.concat(part["value"], part["suffix"]).alias("old"), new.alias("new"), F.split_part(part["kind"], F.lit("-"), F.lit(1)).alias("of"))

        return F.transform(name_parts(e), of)

    def replaced(entity: Column) -> Column:
        def of(e: Column) -> Column:
            person = e["kind"].startswith("person-")

            def made(names: Column) -> Column:
                joined = F.concat(e["prefix"], F.array_join(F.transform(names, lambda n: n["new"]), " "))
                other = _let(attempt_of(e), lambda a: surrogate(key, e, a))
                text = F.when(e.isNull(), entity).when(person, joined).otherwise(other)
                return F.struct(text.alias("text"), e["kind"].alias("kind"), names.alias("names"))

            return _let(F.when(person, renamed(e)), made)

        return _let(parsed(entity), of)

    made, names = free_name(docs, "_made"), free_name(docs, "_names")
    rows = rows.withColumn(made, F.when(F.size(matches) > 0, F.transform(F.col(matches), replaced)))
    of_text = F.flatten(F.filter(F.transform(F.col(made), lambda m: m["names"]), lambda n: n.isNotNull()))
    rows = rows.withColumn(names, F.array_distinct(F.coalesce(of_text, F.array().cast("array<struct<old:string,new:string,of:string>>"))))
    between = F.split(F.col("text"), ENTITY, -1)
    whole = F.array_join(
        F.transform(between, lambda part, i: F.concat(_bare_names(part, F.col(names)), F.coalesce(F.get(F.col(made), i)["text"], F.lit("")))), ""
    )
    kinds = F.filter(F.transform(F.col(made), lambda m: m["kind"]), lambda k: k.isNotNull())
    kept = [F.when(F.col(made).isNotNull(), whole).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in columns if c not in ("n_replaced", "kinds")]
    return rows.select(
        *kept,
        F.when(F.col(made).isNull(), 0).otherwise(F.size(kinds)).cast("bigint").alias("n_replaced"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(kinds)), ","), F.lit("")).alias("kinds"),
    )


def op6_pii_surrogates(spark, sf_dir):
    return with_surrogates(documents(spark, sf_dir).select("doc_id", "text"))


def replaced_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with surrogates in ``text``, in their own columns."""
    return with_surrogates(docs).select(*docs.columns)
