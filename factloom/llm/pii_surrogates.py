"""Personal data and secrets replaced by surrogates, with DataFrame operations only.

One pattern finds the entities of a text. An entity is one unit (an address, a number, a secret), or, for persons, one unit
for each word of the name. A unit's replacement depends on a key and on the unit alone, so the same unit has the same
replacement everywhere (coreference), of the same kind, script, gender and format. Replacements are then checked over the
whole corpus: no two units may share one, and none may equal a unit of the corpus. Those that fail are drawn anew until none
is left; only these few are looked up, all others are computed in place.

Persons are found by what stands around two or three capitalised words: a title, a word that introduces or follows a person,
a label, an e-mail address in brackets, the endings of Russian surnames and patronymics; and by a given name of a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from factloom.llm.names import FOLLOWS, GIVEN, INTRODUCES, LABELS, NO_NAME, TITLES
from factloom.llm.runtime import cut

_ALL_GIVEN = sorted((n for names in GIVEN.values() for n in names), key=lambda n: (-len(n), n))
_FEMALE = sorted(n for (gender, _), names in GIVEN.items() if gender == "f" for n in names)
_TITLES = sorted((t for ts in TITLES.values() for t in ts), key=lambda t: (-len(t), t))
# Repeated groups are possessive or bounded: Java's engine recurses for others, and a long text would overflow its stack.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"(?=[A-Za-z0-9._%+-])(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
KEY = r"(?=[Agsx])(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})(?![A-Za-z0-9])"
#: A secret with the word that announces it; the word and the quote stay.
SECRET = (
    r"""(?=[PpSsTtAaCc])(?i:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|client[_-]?key)["']? ?[=:] ?"""
    r"""(?:["'][^"'\s]{6,}|(?=[^"'\s,;0-9]*+[0-9])[^"'\s,;]{6,})"""
)
_ANNOUNCED = r"""^([^=:]*[=:] ?["']?)(.*)$"""
HEX = r"(?=[0-9a-f])(?<![A-Za-z0-9])(?=[a-f]*+[0-9])(?:[0-9a-f]{40}|[0-9a-f]{64})(?![A-Za-z0-9])"
IP = rf"(?=[0-9])(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])(?!\.[0-9])"
IP6 = (
    r"(?=[0-9A-Fa-f])(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*+(?![0-9A-Za-z]))(?=[A-Fa-f:]*+[0-9])"
    r"(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![0-9A-Za-z:])"
)
PHONE = (
    r"(?=[+(0-9])(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|\(0[0-9]{2,4}\) ?[0-9]{3,8}"
    r"|[2-9][0-9]{2}(?:-[0-9]{3}-|\.[0-9]{3}\.| [0-9]{3} )[0-9]{4}|0[1-9](?:[ .][0-9]{2}){4}|0[1-9][0-9]{1,3}[ /-][0-9]{3,4}[ -]?[0-9]{3,5})(?![0-9A-Za-z]|[.-][0-9])"
)
NATIONAL = r"(?=[0-9])(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?=[0-9])(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])"
IBAN = r"(?=[A-Z])(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_UP, _LOW = "A-ZÀ-ÖØ-ÞŁŚŽŠČА-ЯЁΑ-Ω", "a-zß-öø-ÿąćčďěłńňőřśšťůűźżžа-яёα-ω"
#: A capitalised word that can be part of a name, with O'Brien, McCall and Jean-Luc.
_WORD = rf"(?!(?:{'|'.join(NO_NAME)})(?!\p{{L}}))(?:[{_UP}]['’])?[{_UP}][{_LOW}]++(?:[{_UP}][{_LOW}]++)?+(?:[-'’][{_UP}][{_LOW}]++)?+(?!\p{{L}})"
_FULL = rf"{_WORD}(?: [A-Z]\.)?(?: {_WORD}){{1,2}}"
_PATRONYMIC = r"(?:[А-ЯЁ][а-яё]++ )?[А-ЯЁ][а-яё]++ (?=[А-ЯЁ][а-яё]*(?:вич|ьич|вна|чна)(?!\p{L}))[А-ЯЁ][а-яё]++(?: [А-ЯЁ][а-яё]++)?+"
_RUSSIAN = r"[А-ЯЁ][а-яё]++ (?=[А-ЯЁ][а-яё]+(?:[оеё]ва?|ина?|ск(?:ий|ая)|цк(?:ий|ая)|енко|[ую]к)(?!\p{L}))[А-ЯЁ][а-яё]++"
PERSON = (
    rf"(?=[{_UP}])(?<!\p{{L}})(?:(?:{'|'.join(_TITLES)})\.? (?:{_WORD} ){{0,2}}{_WORD}|(?:{'|'.join(_ALL_GIVEN)})(?!\p{{L}})(?: [A-Z]\.)?(?: {_WORD}){{0,2}}"
    rf"|(?<=(?<!\p{{L}})(?:{'|'.join(INTRODUCES)}) ){_FULL}|(?<=(?:{'|'.join(LABELS)}): ){_FULL}|{_FULL}(?= (?:{'|'.join(FOLLOWS)})(?!\p{{L}})| ?[<(][A-Za-z0-9._%+-]{{1,64}}@)"
    rf"|{_PATRONYMIC}|{_RUSSIAN})"
)
#: In the order in which they are tried.
KINDS = {"secret": SECRET, "email": EMAIL, "key": KEY, "secret_hex": HEX, "iban": IBAN, "ip": rf"{IP}|{IP6}", "phone": PHONE, "national": NATIONAL, "card": CARD, "person": PERSON}
PATTERN = "|".join(KINDS.values())
#: An entity whose surroundings made it a person.
_NAMES = rf"^(?:{PERSON}|{_FULL})$"


def _signs(text: Column) -> Column:
    """False only for texts without any entity but persons: every other kind has one of these signs, which are cheap to look for."""
    signs = [text.rlike("[0-9]"), *(F.contains(text, F.lit(x)) for x in ("@", "AKIA", "ASIA")), text.rlike(r"gh[pousr]_|sk-|xox[abprs]-"), text.rlike("[=:] ?[\"']")]
    out = signs[0]
    for x in signs[1:]:
        out = out | x
    return out


def entities_of(text: Column) -> Column:
    """All entities of a text in order, with numbers that look like a card's but have no valid check digit; none for a null text."""
    none = F.array().cast("array<string>")
    every, persons = (F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in (PATTERN, PERSON))
    return F.when(text.isNull(), none).when(_signs(text), every).otherwise(persons)


#: Letters are drawn from the alphabet that they stand in. Fixed values.
_ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "àáâäåèéêëíîïñóôöøùúûüç", "аеиоуыэюяё", "бвгджзйклмнпрстфхцчшщ", "АЕИОУЭЮЯЁ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ", "αεηιου", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ")
_HEX_ALPHABETS = ("0123456789", "abcdef", "ABCDEF")
_CODE_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Endings that carry gender or origin and stay, longest first. Fixed values.
_ENDINGS = "ович|евич|овна|евна|ична|инична|ский|цкий|ская|цкая|енко|ова|ева|ёва|ина|ов|ев|ёв|ин|ук|юк|ая|а|я|sson|ova|eva|ska|ski|ia|ez|a|o"
#: Names of a word are drawn longer from this attempt on, as short ones are few.
_LONGER = 3


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern matches the entity alone; ``none`` for a card number without a valid check digit or issuer (2 to 6)."""
    out = None
    for kind, pattern in KINDS.items():
        cond = entity.rlike(f"^(?:{pattern})$") if kind != "person" else entity.rlike(_NAMES)
        issued = (entity >= "2") & (entity < "7") & (_luhn_sum(F.regexp_replace(entity, "[^0-9]", "")) % 10 == 0)
        label = F.when(issued, kind).otherwise("none") if kind == "card" else F.lit(kind)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("secret")


def _draw(seed: Column, place: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, place), F.lit(n))


def _letters(value: Column, seed: Column, alphabets: tuple[str, ...]) -> Column:
    """Each character is replaced by one of its own alphabet; others stay, and with them the format.

    ``seed`` is a column or a variable of a higher-order function, never an expression: that would be computed for each character.
    """

    def one(c: Column, i: Column) -> Column:
        out = None
        for a in alphabets:
            cond, new = F.instr(F.lit(a), c) > 0 if len(a) > 10 else F.lit(a).contains(c), F.substr(F.lit(a), (_draw(seed, i, len(a)) + 1).cast("int"), F.lit(1))
            out = F.when(cond, new) if out is None else out.when(cond, new)
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _digits(value: Column, seed: Column, kept: int = 0) -> Column:
    """The k-th digit depends on the seed and k, however the number is written; the first ``kept`` digits stay.

    For values of a few dozen characters, as each looks at all before it.
    """

    def one(c: Column, i: Column) -> Column:
        k = F.length(F.regexp_replace(F.substr(value, F.lit(1), i), "[^0-9]", ""))
        return F.when((c >= "0") & (c <= "9") & (k >= kept), _draw(seed, k, 10).cast("string")).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits, the last one not doubled."""
    every = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, (c.cast("int") * 2) - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(every, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _card(value: Column, seed: Column) -> Column:
    """The first digit stays, and the check digit is valid."""

    def one(new: Column) -> Column:
        head = F.substr(new, F.lit(1), F.length(new) - 1)
        return F.concat(head, ((10 - _luhn_sum(F.concat(F.regexp_replace(head, "[^0-9]", ""), F.lit("0"))) % 10) % 10).cast("string"))

    return F.get(F.transform(F.array(_digits(value, seed, 1)), one), F.lit(0))


def _ip(value: Column, seed: Column) -> Column:
    """An address of the reserved block 240.0.0.0/4, or one of the same form with other hexadecimal digits."""
    plain = F.concat_ws(".", (_draw(seed, F.lit(0), 15) + 240).cast("string"), *[_draw(seed, F.lit(k), 256).cast("string") for k in (1, 2, 3)])
    return F.when(value.contains(":"), _letters(value, seed, _HEX_ALPHABETS)).otherwise(plain)


def _name(value: Column, seed: Column, attempt: Column) -> Column:
    """A word of the same script, case and form; endings that show the gender stay, and a listed female name gets one."""
    ending = F.regexp_extract(value, rf"\p{{L}}({_ENDINGS})$", 1)
    ending = F.when((ending == "") & value.isin(_FEMALE), "a").otherwise(ending)
    stem = F.substr(value, F.lit(1), F.greatest(F.length(value) - F.length(ending), F.lit(1)))
    more = F.when(value.rlike("[а-яё]$"), "лема").when(value.rlike("[α-ω]$"), "λεμα").otherwise("lema")
    return F.concat(_letters(F.concat(stem, F.when(attempt >= _LONGER, more).otherwise("")), seed, _ALPHABETS), ending)


def _units(entity: Column, kind: Column) -> Column:
    """(kind, value) of the units of an entity: words of a name that are no titles or initials, or the entity itself."""
    words = F.filter(F.split(entity, " "), lambda w: ~_fixed(w))
    return F.when(kind == "none", F.array().cast("array<struct<kind:string,value:string>>")).when(
        kind == "person", F.transform(words, lambda w: F.struct(F.lit("name").alias("kind"), w.alias("value")))
    ).otherwise(F.array(F.struct(kind.alias("kind"), entity.alias("value"))))


def _fixed(word: Column) -> Column:
    return F.regexp_replace(word, r"\.$", "").isin(_TITLES) | word.rlike(r"^[A-Z]\.$")


def surrogates(units: Column, key: str, attempt: Column | None = None) -> Column:
    """array<struct<kind, value, s>>: each unit (kind, value) with its replacement. Every unit is hashed once."""
    attempt = F.lit(0) if attempt is None else attempt

    def seeded(u: Column) -> Column:
        kind, entity = u["kind"], u["value"]
        # A secret without the word that announces it is replaced by the same value.
        value = F.when(kind == "secret", F.regexp_extract(entity, _ANNOUNCED, 2)).otherwise(entity)
        label = F.when(kind != "secret", kind).when(value.rlike(f"^(?:{HEX})$"), "secret_hex").when(value.rlike(f"^(?:{KEY})$"), "key").otherwise(kind)
        plain = F.when(kind.isin("phone", "card", "national"), F.regexp_replace(entity, "[^0-9]", "")).when(kind.isin("email", "name"), F.lower(entity)).otherwise(value)
        seed = F.sha2(F.concat_ws("|", F.lit(key), label, plain, attempt.cast("string")), 256)
        domain = F.when(kind == "email", F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.lower(F.substring_index(entity, "@", -1))), 256))
        return F.struct(kind.alias("kind"), entity.alias("e"), value.alias("value"), label.alias("label"), seed.alias("seed"), domain.alias("domain"))

    def replaced(u: Column) -> Column:
        kind, e, value, label, seed = (u[k] for k in ("kind", "e", "value", "label", "seed"))
        host = F.regexp_replace(F.substring_index(e, "@", -1), r"\.[A-Za-z0-9-]+$", "")
        code = F.when(label == "key", F.concat(F.substr(value, F.lit(1), F.lit(4)), _letters(F.substr(value, F.lit(5)), seed, _CODE_ALPHABETS))).otherwise(
            F.when(value.rlike("^[0-9a-f]+$"), _letters(value, seed, _HEX_ALPHABETS)).otherwise(_letters(value, seed, _CODE_ALPHABETS))
        )
        new = (
            F.when(kind == "email", F.concat(_letters(F.substring_index(e, "@", 1), seed, _ALPHABETS[:5]), F.lit("@"), _letters(host, u["domain"], _ALPHABETS[:5]), F.lit(".example")))
            .when(kind == "ip", _ip(e, seed))
            .when(kind == "card", _card(e, seed))
            .when(kind == "phone", _digits(e, seed, 1))
            .when(kind == "national", _digits(e, seed))
            .when(kind == "name", _name(e, seed, attempt))
            .when(kind == "iban", F.concat(F.substr(e, F.lit(1), F.lit(2)), _letters(F.substr(e, F.lit(3)), seed, _CODE_ALPHABETS)))
            .when(kind == "secret", F.concat(F.regexp_extract(e, _ANNOUNCED, 1), code))
            .otherwise(code)
        )
        return F.struct(kind.alias("kind"), e.alias("value"), new.alias("s"))

    return F.transform(F.transform(units, seeded), replaced)


def _described(text: Column, key: str) -> Column:
    """array<struct<e, kind, units>>: the entities of a text with their kinds and the surrogates of their units."""
    kinds = F.transform(entities_of(text), lambda e: F.struct(e.alias("e"), kind_of(e).alias("kind")))
    return F.transform(kinds, lambda x: F.struct(x["e"].alias("e"), x["kind"].alias("kind"), surrogates(_units(x["e"], x["kind"]), key).alias("units")))


def _clashes(taken: DataFrame) -> DataFrame:
    """taken: s, kind, value (null: s is a unit of the corpus). Units whose s another one or the corpus has, but for the first."""
    seen = taken.groupBy("s").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.bool_or(F.col("value").isNull()).alias("real"))
    bad = seen.where("n > 1").select("s", "least", "real")
    return taken.where("value is not null").join(bad, "s").where("real or value != least").select("kind", "value").distinct()


def overrides(units: DataFrame, key: str, rounds: int = 20) -> DataFrame | None:
    """(kind, value, s) for the units whose first replacement clashes with another's or with a unit of the corpus; None if
    none does. units: kind, value, s, distinct, with the first replacements."""
    own = ["kind", "value"]
    real = units.select(F.col("value").alias("s"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("value")).distinct()
    settled = units.select("s", *own)
    again = cut(_clashes(settled.union(real)))
    changed = None
    for attempt in range(1, rounds + 1):
        if again.isEmpty():
            return changed
        settled = settled.join(again, own, "left_anti").select("s", *own)
        fresh = again.select(F.inline(surrogates(F.array(F.struct("kind", "value")), key, F.lit(attempt)))).select("s", *own)
        everything = cut(settled.union(fresh))
        # The earlier ones stay, so only the fresh ones may be at fault.
        bad = _clashes(everything.union(real)).join(fresh.select(*own), own, "left_semi")
        changed = fresh if changed is None else changed.join(again, own, "left_anti").select("s", *own).union(fresh)
        changed, again, settled = cut(changed), cut(bad), everything
    if again.isEmpty():
        return changed
    raise RuntimeError("surrogates of some entities still clash; use another key")


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", check: bool = True) -> DataFrame:
    """docs with surrogates in text_col, and n_entities long and kinds string (distinct, sorted, comma-joined).

    A null text stays null; a text without entities stays as it is. Repeated rows get the same replacements. Columns of the
    two names are replaced, and all others, whatever their names, are left alone.
    """
    docs = docs.drop("n_entities", "kinds")
    names, own = docs.columns, "_pii"
    while any(c.startswith(own) for c in names):
        own += "_"
    ents_, text_, map_ = (own + x for x in ("ents", "text", "map"))
    changed = None
    if check:
        units = docs.select(F.explode(_described(F.col(f"`{text_col}`"), key)).alias("x")).select(F.explode("x.units").alias("u")).select("u.*")
        changed = overrides(cut(units.distinct()), key)
    found = docs.withColumn(ents_, _described(F.col(f"`{text_col}`"), key))
    chosen = lambda u: u["s"]
    if changed is not None:
        # Texts with a clashing unit, by 128 bits of the text, and a map of what to put there instead.
        t = F.col(f"`{text_col}`")
        text = F.struct(F.xxhash64(t).alias("x"), F.xxhash64(F.lit(1), t).alias("y"))
        uses = docs.select(text.alias(text_), F.explode(_described(t, key)).alias("x")).select(text_, F.explode("x.units").alias("u")).select(text_, "u.kind", "u.value")
        uses = uses.distinct().join(changed, ["kind", "value"])
        maps = uses.groupBy(text_).agg(F.map_from_entries(F.collect_list(F.struct(F.struct("kind", "value"), F.col("s")))).alias(map_))
        found = found.withColumn(text_, text).join(maps, text_, "left").drop(text_)
        chosen = lambda u: F.coalesce(F.element_at(F.col(map_), F.struct(u["kind"], u["value"])), u["s"])

    def put(x: Column) -> Column:
        """The entity with its units replaced, in order; titles and initials of a name stay."""
        words = F.split(x["e"], " ")
        place = lambda i: F.size(F.filter(F.slice(words, 1, i), lambda w: ~_fixed(w)))
        new = F.transform(words, lambda w, i: F.when(_fixed(w), w).otherwise(chosen(F.get(x["units"], place(i)))))
        return F.when(x["kind"] == "none", x["e"]).when(x["kind"] == "person", F.array_join(new, " ")).otherwise(chosen(F.get(x["units"], F.lit(0))))

    t, ents = F.col(f"`{text_col}`"), F.col(ents_)
    real = F.filter(ents, lambda x: x["kind"] != "none")
    gaps = F.when(_signs(t), F.split(t, PATTERN, -1)).otherwise(F.split(t, PERSON, -1))
    text = F.when(F.size(real) == 0, t).otherwise(F.array_join(F.zip_with(gaps, F.transform(ents, put), lambda gap, s: F.concat(gap, F.coalesce(s, F.lit("")))), ""))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform(real, lambda x: x["kind"]))), ",")
    return found.select(*[text.alias(text_col) if c == text_col else F.col(f"`{c}`") for c in names], F.size(real).cast("long").alias("n_entities"), kinds.alias("kinds"))
