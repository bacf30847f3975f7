"""Personal data replaced by keyed surrogates, with SQL functions only.

Mentions are found by one pattern over the whole text: e-mail addresses, secrets (access keys, passwords, tokens), IPv4 and
IPv6 addresses, account numbers (IBAN), card numbers, US social security numbers, phone numbers, and names behind a form of
address; keywords and forms of address in any case. A name has up to four parts, with particles, hyphens, apostrophes,
initials and inner capitals; in capitals, two. Wherever a word of such a name stands alone in the same document, it is a
mention too. Names that no form of address leads to in their document aren't found.

A mention is made of units: the digits of a number whatever its format, a number of country 1 with or without it, the
lower-cased address, each word of a name. Each distinct unit of the corpus gets one surrogate, drawn from SHA-256 of the
key, the kind, the unit and the attempt. So one person's number, address or surname becomes the same one in every document
and format, and stays the same with the same key.

Surrogates keep the kind and shape: digits stay digits, letters letters of their case, addresses go under reserved
example domains, public IPv4 addresses into the reserved block, private ones stay in their own block, card numbers keep
their length and whether their check digit holds, names keep the gender of the form of address, their capitals and the
script (Latin, Cyrillic, Greek); a doctor or professor is of either. Account numbers keep their country, and whether their
check digits hold.

Numbers, secrets and private addresses have spaces that a corpus can fill, so they are permuted: every character is
shifted within its class by what a keyed hash makes of those before it, from the left and then from the right, and the
first one never stays. That maps each format onto itself, one to one, and nothing to itself. Other kinds are drawn from
spaces that grow with each attempt: a surrogate that another unit holds, or that is itself a unit of the corpus, is a
collision, and all but the first owner draw again. So different units stay different, and rounds are few.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import fresh, row_key, sized_join, written

#: Forms of address in any case, Greek capitals without accents; small "ms" and "miss" are a unit and a verb.
FEMALE = "(?iu:Mrs|Frau|Madame|Madam|Mme|Dame|Señora|Sra|г-жа|госпожа|κυρ[ίι]α)|M[sS]|Miss|MISS"
MALE = "(?iu:Mr|Sir|Herr|Monsieur|Señor|Sr|г-н|господин|κ[ύυ]ριος)"
EITHER = "(?iu:Dr|Doctor|Prof|Professor|Mx)"
TITLE = rf"(?:{FEMALE}|{MALE}|{EITHER})\.? (?:(?:{EITHER})\.? )?"
KEYWORD = "(?i:password|passwd|pwd|secret|token|api_key|apikey)"
#: A word of a name with capitals inside or not; what may join such words; and parts, of which particles come first.
ATOM = r"\p{Lu}(?:\p{Ll}|\p{Lu}\p{Ll}){1,24}"
PARTICLE = "(?:van|von|de|der|den|del|della|di|da|du|la|le|ten|ter|bin|ibn|al|el|zu|dos|das) "
PART = rf"(?:{PARTICLE}){{0,2}}(?:(?:[OD]['’])?{ATOM}(?:[-'’]{ATOM}){{0,2}}|\p{{Lu}}\.)"
CAPITALS = r"\p{Lu}{2,25}(?:[-'’]\p{Lu}{2,25})?"
#: Any word of two letters or more that a name's mention replaces.
WORD = r"\p{Lu}\p{L}{1,50}"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])"
PRIVATE = r"^(?:10\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|127\.)"
CARD = r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])"
IPV6 = r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[A-Fa-f]{0,3}[0-9])[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z:])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![0-9A-Za-z])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_ABROAD, _GROUP = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})", r"(?:[ .-]?[0-9]{2,4})"
#: Patterns by kind, in the order in which they are tried at a place. Quantifiers are bounded, so that long runs cost no more.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,6}",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    # What is cheap to see goes first: a sign in front, then the keyword.
    "secret": rf"(?<=[=: \"'])(?<=[=:] {{0,2}}[\"']{{0,1}})(?<={KEYWORD}[ ]{{0,2}}[=:][ ]{{0,2}}[\"']{{0,1}})[A-Za-z0-9+/_-]{{8,128}}",
    "ip": IP,
    "ipv6": IPV6,
    "iban": IBAN,
    "card": CARD,
    "ssn": SSN,
    # A phone number in front of another number ends before it.
    "phone": rf"(?<![0-9A-Za-z])(?:{_ABROAD}{_GROUP}{{2,4}}?(?= (?:{IP}|{CARD}|{SSN}))|{_ABROAD}{_GROUP}{{2,4}}|\([0-9]{{3}}\) ?[0-9]{{3}}[ .-][0-9]{{4}}|[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}|(?=[2-9][0-9]{{9}})(?<=(?i:phone|mobile|cell|call|tel|fax)[:.]? {{0,2}})[2-9][0-9]{{9}})(?![0-9])",
    "name": rf"(?<![\p{{L}}\p{{N}}]){TITLE}(?:{PART}(?: {PART}){{0,3}}|{CAPITALS}(?: {CAPITALS})?)(?!\p{{L}})",
}
ANY = "|".join(PATTERNS.values())
#: What a text must hold for the pattern to be tried at all.
MAYBE = rf"@|[0-9][0-9 .()/-]{{5}}|A[KS]IA|{KEYWORD} {{0,2}}[=:]|:[0-9A-Fa-f]{{0,4}}:|[A-Z]{{2}}[0-9]{{2}}[ A-Z0-9]{{6}}|(?<![\p{{L}}\p{{N}}])(?:{FEMALE}|{MALE}|{EITHER})\.? "
LOWER, UPPER, DIGITS, SIGNS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_-"
#: Kinds whose surrogates are a permutation of the units' own spaces.
PERMUTED = ("phone", "phone+", "card", "ssn", "secret", "access_key", "private_ip", "ipv6", "iban")
#: Before a word of a name that stands alone, its kind between two of these.
ALONE = "\x1f"
#: Attempts after which an assignment fails, and units that one task draws for.
MOST_ATTEMPTS = 24
TASK_UNITS = 5_000
#: Consonants, vowels, and endings of female, male and family names, and of names of either gender, by script.
SOUNDS = {
    "latin": ("bdfghjklmnprstvz", "aeiou", ("a", "ina", "elle"), ("en", "or", "us"), ("er", "man", "ow"), ("an", "el", "is")),
    "cyrillic": ("бвгджзклмнпрстф", "аеиоу", ("а", "ина", "ия"), ("ин", "ор", "ей"), ("енко", "ко", "их"), ("ан", "ель", "ис")),
    "greek": ("βγδζθκλμνπρστφχ", "αειου", ("α", "ινη", "ια"), ("ος", "ης", "ων"), ("ου", "ακη", "ιδη"), ("ι", "ις", "υ")),
}
#: Whose endings follow in SOUNDS.
WHO = ("female", "male", "family", "either")


def _kind(mention: Column) -> Column:
    """The first kind whose pattern the whole mention matches; secrets are known by their surroundings, so they come last."""
    bare = {k: p for k, p in PATTERNS.items() if k != "secret"}
    # A phone number of digits alone is known by what stands before it, too.
    out = F.when(F.regexp_like(mention, F.lit("^[2-9][0-9]{9}$")), "phone").otherwise("secret")
    for kind, pattern in reversed(bare.items()):
        out = F.when(F.regexp_like(mention, F.lit(f"^(?:{pattern})$")), F.lit(kind)).otherwise(out)
    return F.when(F.startswith(mention, F.lit(ALONE)), "alone").otherwise(out)


def _behind_title(mention: Column) -> Column:
    return F.regexp_replace(mention, rf"^{TITLE}", "")


def _named(mention: Column) -> Column:
    """The words of a name behind its form of address as an array of (kind, unit); those of the last part are the family's."""
    rest = _behind_title(mention)
    words = F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))
    n_last = F.size(F.regexp_extract_all(F.element_at(F.split(rest, " "), -1), F.lit(WORD), F.lit(0)))
    is_title = lambda of: F.regexp_like(mention, F.lit(rf"^(?:{of})\.? "))
    gender = F.when(is_title(FEMALE), "female").when(is_title(MALE), "male").otherwise("either")
    script = lambda w: F.when(F.regexp_like(w, F.lit(r"\p{IsCyrillic}")), "cyrillic").when(F.regexp_like(w, F.lit(r"\p{IsGreek}")), "greek").otherwise("latin")
    return F.transform(words, lambda w, i: F.struct(F.concat_ws(".", F.when(i >= F.size(words) - n_last, "family").otherwise(gender), script(w)).alias("kind"), F.lower(w).alias("unit")))


def _units(kind: Column, mention: Column) -> Column:
    """The units of a mention as an array of (kind, unit)."""
    one = lambda k, u: F.array(F.struct(k.alias("kind"), u.alias("unit")))
    digits, known = F.regexp_replace(mention, "[^0-9]", ""), F.split(mention, ALONE)
    # Country 1 has ten digits within.
    home = F.startswith(mention, F.lit("+1")) & (F.length(digits) == 11)
    phone = F.when(home, F.substring(digits, 2, 10)).otherwise(digits)
    return (
        F.when(kind == "alone", one(F.get(known, F.lit(1)), F.lower(F.get(known, F.lit(2)))))
        .when(kind == "name", _named(mention))
        .when(kind.isin("email", "ipv6"), one(kind, F.lower(mention)))
        .when(kind == "iban", one(kind, F.replace(mention, F.lit(" "), F.lit(""))))
        .when(kind == "phone", one(F.when(F.startswith(mention, F.lit("+")) & ~home, "phone+").otherwise("phone"), phone))
        .when(kind.isin("card", "ssn"), one(kind, digits))
        .when((kind == "ip") & F.regexp_like(mention, F.lit(PRIVATE)), one(F.lit("private_ip"), mention))
        .otherwise(one(kind, mention))
    )


def _draw(key: str, salt: list[Column], i: Column, size: int | Column) -> Column:
    """A number from 0 to below size for place i, from SHA-256 of the key and the salt."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), *salt, i.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size) if isinstance(size, int) else size)


def _letter(alphabet: str, at: Column) -> Column:
    return F.substr(F.lit(alphabet), at.cast("int") + 1, F.lit(1))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use of a value that is computed once and stands in the plan once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _shifted(c: Column, by: Callable[[Column], Column], hexed: Column) -> Column:
    """A character moved within its class; by gives the distance for a class of so many. Others stay."""
    within = lambda alphabet: F.contains(F.lit(alphabet), c)
    own = F.when(within(DIGITS), DIGITS).when(hexed & within("abcdef"), "abcdef").when(within(LOWER), LOWER).when(within(UPPER), UPPER).when(within(SIGNS), SIGNS).otherwise(c)
    return _bound(own, lambda a: F.substr(a, F.pmod(F.instr(a, c) - 1 + by(F.length(a)), F.length(a)).cast("int") + 1, F.lit(1)))


def permuted(key: str, salt: list[Column], text: Column, hexed: Column) -> Column:
    """text with every character moved within its class, one to one among texts of that shape; the first one never stays."""
    step = lambda way, c, done: F.concat(done, _shifted(c, lambda n: _draw(key, [*salt, F.lit(way), done], F.length(done), n), hexed))
    right = F.aggregate(F.split(text, ""), F.lit(""), lambda done, c: step("right", c, done))
    left = F.aggregate(F.reverse(F.split(F.substr(right, F.lit(2)), "")), F.lit(""), lambda done, c: step("left", c, done))
    first = lambda done: _shifted(F.substring(text, 1, 1), lambda n: _draw(key, [*salt, F.lit("first"), done], F.length(done), F.greatest(n - 1, F.lit(1))) + 1, hexed)
    return _bound(F.when(F.length(text) > 1, left).otherwise(F.lit("")), lambda done: F.concat(first(done), F.reverse(done)))


def _surrogate(key: str, kind: Column, unit: Column, attempt: Column) -> Column:
    """The surrogate of a unit at an attempt."""
    salt = [kind, unit, attempt.cast("string")]
    draw = lambda i, size: _draw(key, salt, i, size)

    def shaped(text: Column) -> Column:
        letter = lambda c, i: (
            F.when(F.regexp_like(c, F.lit("[0-9]")), _letter(DIGITS, draw(i, 10))).when(F.regexp_like(c, F.lit("[a-z]")), _letter(LOWER, draw(i, 26))).otherwise(c)
        )
        return F.array_join(F.transform(F.split(text, ""), letter), "")

    at = lambda n: F.lit(n)
    local, domain = F.substring_index(unit, "@", 1), F.substring_index(unit, "@", -1)
    # The last two labels go under a reserved domain, those before it keep their shape; locals grow with attempts.
    labels = F.split(domain, r"\.")
    inner = F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0)))
    reserved = F.element_at(F.array(*map(F.lit, ("example.com", "example.org", "example.net"))), draw(at(9001), 3).cast("int") + 1)
    longer = F.array_join(F.transform(F.slice(F.sequence(F.lit(9100), F.lit(9100) + attempt), 2, MOST_ATTEMPTS), lambda i: _letter(LOWER, draw(i, 26))), "")
    email = F.concat(shaped(local), longer, F.lit("@"), F.when(F.size(inner) > 0, F.concat(shaped(F.array_join(inner, ".")), F.lit("."))).otherwise(F.lit("")), reserved)

    octet = lambda n: draw(at(n), 256).cast("string")
    # The reserved block, and from the fifth attempt blocks that are twice as large.
    public = F.concat_ws(".", F.when(attempt < 4, draw(at(0), 15) + 240).otherwise(draw(at(0), 31) + 193).cast("string"), octet(1), octet(2), octet(3))
    octets = F.split(unit, r"\.")
    o = lambda i: F.element_at(octets, i).cast("int")
    turn = lambda name, parts, n: _draw(key, [kind, F.lit(name), F.element_at(octets, 1), *(x.cast("string") for x in parts)], F.lit(0), n)
    narrow = F.startswith(unit, F.lit("192.")) | F.startswith(unit, F.lit("172."))
    d = F.pmod(o(4) + turn("d", [o(2), o(3)], 256), F.lit(256))
    # The block of 192.168 has two free octets, that of 172 a second one of 16 values; the third never stays in these.
    c = F.when(narrow, F.pmod(o(3) + 1 + turn("c", [o(2), d], 255), F.lit(256))).otherwise(F.pmod(o(3) + turn("c", [o(2), d], 256), F.lit(256)))
    b = F.when(F.startswith(unit, F.lit("192.")), o(2)).when(F.startswith(unit, F.lit("172.")), F.pmod(o(2) - 16 + turn("b", [c, d], 16), F.lit(16)) + 16).otherwise(F.pmod(o(2) + 1 + turn("b", [c, d], 255), F.lit(256)))
    private = F.concat_ws(".", F.element_at(octets, 1), b.cast("string"), c.cast("string"), d.cast("string"))

    def luhn(digits: Column) -> Column:
        """The sum that a valid number has as a multiple of ten, of all digits."""
        n = F.length(digits)
        value = lambda i: F.substr(digits, i, F.lit(1)).cast("int")
        twice = lambda i: F.when((n - i) % 2 == 1, F.when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2)).otherwise(value(i))
        return F.aggregate(F.transform(F.sequence(F.lit(1), n), twice), F.lit(0), lambda s, x: s + x)

    # The first digit of phones and cards and the prefix of access keys stay, and a card's last digit follows from the rest.
    head = F.when(kind.isin("phone", "phone+", "card"), F.substring(unit, 1, 1)).when(kind.isin("access_key", "iban"), F.substring(unit, 1, 4)).otherwise("")
    tail = F.substr(unit, F.length(head) + 1, F.length(unit) - F.length(head) - F.when(kind == "card", 1).otherwise(0))
    hexed = (kind == "ipv6") | ((kind == "secret") & F.regexp_like(unit, F.lit("^[0-9a-f]+$")))
    moved = F.concat(head, _bound(tail, lambda t: permuted(key, [kind, attempt.cast("string"), F.length(t).cast("string")], t, hexed)))
    # What a check digit is off by stays, so that valid numbers stay valid, wrong ones wrong, and different ones different.
    def remainder(account: Column) -> Column:
        """By 97, of an account number as its check digits see it: they and the country go to the end, letters count from 10."""
        value = lambda c: F.instr(F.lit(DIGITS + UPPER), c) - 1
        return F.aggregate(F.split(F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4)), ""), F.lit(0), lambda r, c: F.when(value(c) > 9, (r * 100 + value(c)) % 97).otherwise((r * 10 + value(c)) % 97))

    def checked(m: Column) -> Column:
        zero = F.concat(F.substring(m, 1, 2), F.lit("00"), F.substr(m, F.lit(5)))
        check = F.pmod(remainder(unit) - remainder(zero) - 2, F.lit(97)) + 2
        return F.concat(F.substring(m, 1, 2), F.lpad(check.cast("string"), 2, "0"), F.substr(m, F.lit(5)))

    number = _bound(moved, lambda m: F.when(kind == "iban", checked(m)).when(kind == "card", F.concat(m, F.pmod(luhn(unit) - luhn(F.concat(m, F.lit("0"))), F.lit(10)).cast("string"))).otherwise(m))

    def sound(part: int) -> Column:
        of = lambda script: F.lit(SOUNDS[script][part])
        return F.when(F.endswith(kind, F.lit(".cyrillic")), of("cyrillic")).when(F.endswith(kind, F.lit(".greek")), of("greek")).otherwise(of("latin"))

    def picked(alphabet: Column, at: Column) -> Column:
        return F.substr(alphabet, F.pmod(at, F.length(alphabet)).cast("int") + 1, F.lit(1))

    whole = 1 << 40
    syllable = lambda i: F.concat(picked(sound(0), draw(i * 2, whole)), picked(sound(1), draw(i * 2 + 1, whole)))
    root = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2) + F.floor(attempt / 2).cast("int")), syllable), "")
    endings = [(f"{who}.{script}", SOUNDS[script][2 + i]) for script in SOUNDS for i, who in enumerate(WHO)]
    known = F.create_map(*(x for k, e in endings for x in (F.lit(k), F.array(*map(F.lit, e)))))
    ending = F.element_at(F.try_element_at(known, kind), draw(at(9005), 3).cast("int") + 1)
    name = F.concat(root, F.substring(sound(0), 9, 1), ending)
    return F.when(kind == "email", email).when(kind == "ip", public).when(kind == "private_ip", private).when(kind.isin(*PERMUTED), number).otherwise(name)


def assigned(units: DataFrame, key: str) -> DataFrame:
    """kind, unit and surrogate of each distinct (kind, unit); within a kind, surrogates differ, and none is its own unit.

    Drawn surrogates are no unit of the corpus either; permuted ones may be another's. Raises after MOST_ATTEMPTS rounds.
    """
    units = written(units.select("kind", "unit").distinct(), "units")
    kept, open_ = [], units
    for attempt in range(MOST_ATTEMPTS):
        tasks = min(20_000, open_.count() // TASK_UNITS + 1)
        drawn = open_.repartition(tasks, "unit").select("kind", "unit", _surrogate(key, F.col("kind"), F.col("unit"), F.lit(attempt)).alias("surrogate"))
        taken = units.where(~F.col("kind").isin(*PERMUTED)).select("kind", F.col("unit").alias("surrogate"))
        for k in kept:
            taken = taken.unionByName(k.select("kind", "surrogate"))
        drawn = written(drawn.join(taken, ["kind", "surrogate"], "left_anti"), "drawn")
        kept.append(written(drawn.groupBy("kind", "surrogate").agg(F.min("unit").alias("unit")), "surrogates"))
        open_ = written(open_.join(kept[-1], ["kind", "unit"], "left_anti"), "open")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, kept)
    raise RuntimeError(f"units without a surrogate after {MOST_ATTEMPTS} attempts: {open_.groupBy('kind').count().collect()}")


def _rendered(kind: Column, mention: Column, surrogates: Column) -> Column:
    """The surrogates of a mention's units in the mention's own format."""
    digits = F.element_at(surrogates, 1)
    own = F.regexp_replace(mention, "[^0-9]", "")
    # A country code that isn't part of the unit stays.
    behind = F.when(kind == "phone", F.length(own) - F.length(digits)).otherwise(0)
    place = lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1), "[^0-9]", "")) - behind
    number = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(F.regexp_like(c, F.lit("[0-9]")) & (place(i) > 0), F.substr(digits, place(i), F.lit(1))).otherwise(c)), "")
    spot = lambda i: F.length(F.replace(F.substr(mention, F.lit(1), i + 1), F.lit(" "), F.lit("")))
    account = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substr(digits, spot(i), F.lit(1)))), "")
    cased = lambda s, w: F.when(w == F.upper(w), F.upper(s)).otherwise(F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2))))
    rest = _behind_title(mention)
    title = F.substr(mention, F.lit(1), F.length(mention) - F.length(rest))
    words = F.zip_with(surrogates, F.regexp_extract_all(rest, F.lit(WORD), F.lit(0)), cased)
    name = F.array_join(F.zip_with(F.split(rest, WORD, -1), words, lambda gap, w: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(w, F.lit("")))), "")
    alone = cased(digits, F.get(F.split(mention, ALONE), F.lit(2)))
    return F.when(kind == "alone", alone).when(kind == "name", F.concat(title, name)).when(kind == "iban", account).when(kind.isin("phone", "card", "ssn"), number).otherwise(digits)


def replaced(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with its own columns, where text holds surrogates, and n_entities, the mentions that were replaced.

    n_entities gets underscores in front if docs has it already. A null text stays null, with none. Repeated rows are
    returned as often as they stand; rows without doc_id are taken apart by their texts. Very long texts are searched
    whole. An empty table gives no rows.
    """
    row, swaps, n_entities, pattern = fresh(docs, "row_key", "swaps", "n_entities", "pattern")
    keyed = docs.withColumn(row, row_key(doc_id, text))
    found = keyed.where(F.regexp_like(F.col(text), F.lit(MAYBE))).select(F.col(row).alias("row"), F.col(text).alias("text"), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)).alias("mentions"))
    # Names that a document gives with a form of address, by word, the first kind of a word counting.
    titled = F.filter("mentions", lambda m: F.regexp_like(m, F.lit(rf"^{PATTERNS['name']}$")))
    words = F.flatten(F.transform(titled, lambda m: F.transform(F.arrays_zip(_named(m).alias("n"), F.regexp_extract_all(_behind_title(m), F.lit(WORD), F.lit(0)).alias("w")), lambda x: F.struct(x["w"].alias("w"), x["n"]["kind"].alias("kind")))))
    hits = found.where(F.size("mentions") > 0).dropDuplicates(["row"]).withColumn("words", words)
    spelled = F.array_distinct(F.flatten(F.transform("words", lambda x: F.array(x["w"], F.upper(x["w"])))))
    alone = F.when(F.size("words") > 0, F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(spelled, "|"), F.lit(r")(?![\p{L}\p{N}])"))).otherwise(F.lit(ANY))
    hits = hits.withColumn("pattern", alone)
    of = lambda m: F.element_at(F.filter("words", lambda x: (x["w"] == m) | (F.upper(x["w"]) == m)), 1)["kind"]
    again = F.transform(F.regexp_extract_all("text", F.col("pattern"), F.lit(0)), lambda m: F.when(F.regexp_like(m, F.lit(rf"^{WORD}$")) & F.exists("words", lambda x: (x["w"] == m) | (F.upper(x["w"]) == m)), F.concat(F.lit(ALONE), of(m), F.lit(ALONE), m)).otherwise(m))
    hits = written(hits.select("row", F.when(F.size("words") > 0, again).otherwise(F.col("mentions")).alias("mentions"), F.when(F.size("words") > 0, F.col("pattern")).alias("pattern")), "mentions")
    places = hits.select("row", F.posexplode("mentions").alias("place", "mention"))
    kinds = places.select("mention").distinct().withColumn("kind", _kind(F.col("mention")))
    mentions = written(kinds.withColumn("units", _units(F.col("kind"), F.col("mention"))), "kinds")
    parts = mentions.select("mention", F.col("kind").alias("of"), F.posexplode("units").alias("nth", "u")).select("mention", "of", "nth", "u.kind", "u.unit")
    table = assigned(parts, key)
    # A mention has a dozen units at most.
    built = parts.join(table, ["kind", "unit"]).groupBy("mention", "of").agg(F.sort_array(F.collect_list(F.struct("nth", "surrogate"))).alias("units"))
    swap = written(built.select("mention", _rendered(F.col("of"), F.col("mention"), F.col("units.surrogate")).alias("swap")), "swaps")
    # One row gathers the mentions of one document.
    lists = sized_join(places, swap, "mention", "inner").groupBy(F.col("row").alias(row)).agg(F.sort_array(F.collect_list(F.struct("place", "swap"))).alias(swaps))
    own = hits.select(F.col("row").alias(row), F.col("pattern").alias(pattern))
    lists = written(lists.select(row, F.col(f"{swaps}.swap").alias(swaps)).join(own, row), "lists")
    joined = sized_join(keyed, lists, row, "left")
    pieces = F.zip_with(F.when(F.col(pattern).isNull(), F.split(F.col(text), ANY, -1)).otherwise(F.split(F.col(text), F.col(pattern), -1)), F.col(swaps), lambda piece, other: F.concat(F.coalesce(piece, F.lit("")), F.coalesce(other, F.lit(""))))
    new = F.when(F.col(swaps).isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))
    count = F.when(F.col(swaps).isNull(), F.lit(0)).otherwise(F.size(swaps)).cast("long")
    return joined.select(*(new.alias(c) if c == text else F.col(c) for c in docs.columns), count.alias(n_entities))
