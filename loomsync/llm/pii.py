"""Format-preserving pseudonyms by a keyed Feistel network, in DataFrame functions only.

Found and validated: mail addresses, phone numbers of +1 and ten digits, payment card numbers (Luhn),
social security numbers, IPv4 addresses, and dates (ISO with - or /, and d.m.y) from 1800 to
2199. Each is permuted within the valid values of its format, so equal values get equal
pseudonyms in every document and different ones stay different:

* mail, phone, card: characters at even and odd places are the two halves; a round adds, per
  character, a keyed number from the other half within the character's own class; a phone's
  area and exchange begin with a digit from 2 or with 0 or 1, as before. Separators,
  the country code, a card's first digit and the mail domain stay; a card's check digit is
  computed anew.
* the others are a pair of numbers (area and group, serial; two halves of an address; the day
  within the 400-year cycle of 189 x 773 days), and a round adds to one a keyed number from
  the other.

What does not validate is left as it is. A date may be followed by T and a time, which stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
#: For tests and checks only: whoever knows the key can turn pseudonyms back.
TEST_KEY = "loomsync"

_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_PHONE = r"\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
_IP = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_CARD = r"[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{13,19}"
KINDS = {"mail": _MAIL, "phone": _PHONE, "ip": _IP, "date": _DATE, "ssn": _SSN, "card": _CARD}
#: One character that is no word character, or the start, then a value with all that clings to it; a date ends before T and a time.
_FOUND = rf"(?:^|[^A-Za-z0-9_])(?:(?:{_MAIL})[A-Za-z0-9_]*|(?:{_DATE})(?=T[0-9]{{2}})|(?:{'|'.join(KINDS.values())})[A-Za-z0-9_]*)"
#: The same for engines that cannot look ahead: the T and two digits, which no value can begin in, are taken along.
PATTERN = _FOUND.replace("(?=T[0-9]{2})", "T[0-9]{2}")
_LEAD = r"^[^A-Za-z0-9_+]"

_SIZES = {"date": (189, 773), "ssn": (898 * 99, 9999), "ip": (65536, 65536)}


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _number(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length).cast("int")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _check_digit(digits: Column) -> Column:
    """Luhn digit of a number whose last digit is not looked at."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + d - F.when(d > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits) - 1), F.lit(0), add)
    return (10 - total % 10) % 10


def _kind(core: Column) -> Column:
    """Name of the format that ``core`` is valid in, else null."""

    def whole(name: str) -> Column:
        return core.rlike(f"^(?:{KINDS[name]})$")

    digits = _digits(core)
    octets = F.forall(F.split(core, r"\."), lambda x: x.cast("int") <= 255)
    year, month, day = _date_parts(core)
    days = F.when(month.isin(4, 6, 9, 11), 30).when(month != 2, 31).when((year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0)), 29).otherwise(28)
    date = year.between(1800, 2199) & month.between(1, 12) & (day >= 1) & (day <= days)
    area = _number(core, 1, 3)
    ssn = (area >= 1) & (area <= 899) & (area != 666) & (_number(core, 5, 2) >= 1) & (_number(core, 8, 4) >= 1)
    phone = digits.rlike("^1[0-9]{10}$")
    card = _check_digit(digits) == F.substr(digits, F.length(digits), F.lit(1)).cast("int")
    kind = F.when(whole("mail"), F.lit("mail"))
    for name, valid in (("phone", phone), ("ip", octets), ("date", date), ("ssn", ssn), ("card", card)):
        kind = kind.when(whole(name), F.when(valid, F.lit(name)))
    return kind


def _date_parts(core: Column) -> tuple[Column, Column, Column]:
    iso = F.substring(core, 3, 1) != "."
    year = F.when(iso, _number(core, 1, 4)).otherwise(_number(core, 7, 4))
    month = F.when(iso, _number(core, 6, 2)).otherwise(_number(core, 4, 2))
    day = F.when(iso, _number(core, 9, 2)).otherwise(_number(core, 1, 2))
    return year, month, day


def _classes(core: Column, kind: Column) -> Column:
    """Class of each character: d digit, n digit from 2, b 0 or 1, l and u letters, f fixed."""
    at, all_digits = F.locate("@", core), F.length(_digits(core))

    def one(i: Column) -> Column:
        c = F.substr(core, i, F.lit(1))
        digit, nth = c.rlike("[0-9]"), F.length(_digits(F.substr(core, F.lit(1), i)))
        mail = F.when(i > at, "f").when(digit, "d").when(c.rlike("[a-z]"), "l").when(c.rlike("[A-Z]"), "u").otherwise("f")
        phone = F.when(~digit | (nth == 1), "f").when(nth.isin(2, 5), F.when(c >= "2", "n").otherwise("b")).otherwise("d")
        card = F.when(~digit | (nth == 1) | (nth == all_digits), "f").otherwise("d")
        return F.when(kind == "mail", mail).when(kind == "phone", phone).otherwise(card)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(core)), one), "")


def _hash(key: str, kind: Column, r: Column, other: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{key}:"), kind, F.lit(":"), r.cast("string"), F.lit(":"), other.cast("string")))


def _hex(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def _characters(core: Column, kind: Column, key: str) -> Column:
    def turn(text: Column, r: Column, classes: Column) -> Column:
        even = r % 2 == 0
        other = F.when(even, F.regexp_replace(text, ".(.?)", "$1")).otherwise(F.regexp_replace(text, "(.).?", "$1"))

        def one(i: Column, keyed: Column) -> Column:
            c, cls = F.substr(text, i + 1, F.lit(1)), F.substr(classes, i + 1, F.lit(1))
            by = _hex(F.substr(keyed, 1 + 2 * (F.floor(i / 2).cast("int") % 16), F.lit(2)))
            moved = c
            for name, base, size in (("d", 48, 10), ("n", 50, 8), ("b", 48, 2), ("l", 97, 26), ("u", 65, 26)):
                moved = F.when(cls == name, F.char(F.lit(base) + (F.ascii(c) - base + by) % size)).otherwise(moved)
            return F.when((i % 2 == r % 2), moved).otherwise(c)

        places = F.sequence(F.lit(0), F.length(text) - 1)
        return _bind(_hash(key, kind, r, other), lambda keyed: F.array_join(F.transform(places, lambda i: one(i, keyed)), ""))

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    moved = _bind(_classes(core, kind), lambda classes: F.aggregate(rounds, core, lambda text, r: turn(text, r, classes)))
    renewed = _bind(moved, lambda m: F.concat(F.substr(m, F.lit(1), F.length(m) - 1), _check_digit(_digits(m)).cast("string")))
    return F.when(kind == "card", renewed).otherwise(moved)


def _pair(first: Column, second: Column, name: str, key: str) -> Column:
    a_size, b_size = _SIZES[name]

    def turn(pair: Column, r: Column) -> Column:
        a, b = pair["a"], pair["b"]
        by = _hex(F.substr(_hash(key, F.lit(name), r, F.when(r % 2 == 0, b).otherwise(a)), F.lit(1), F.lit(8)))
        return F.struct(F.when(r % 2 == 0, (a + by) % a_size).otherwise(a).alias("a"), F.when(r % 2 == 1, (b + by) % b_size).otherwise(b).alias("b"))

    start = F.struct(first.cast("long").alias("a"), second.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _ip(core: Column, key: str) -> Column:
    part = F.split(core, r"\.")
    number = [F.element_at(part, i + 1).cast("int") for i in range(4)]
    pair = _pair(number[0] * 256 + number[1], number[2] * 256 + number[3], "ip", key)
    return _bind(pair, lambda p: F.concat_ws(".", *(x.cast("int").cast("string") for v in (p["a"], p["b"]) for x in (F.floor(v / 256), v % 256))))


def _ssn(core: Column, key: str) -> Column:
    area = _number(core, 1, 3)
    place = area - F.when(area > 666, 2).otherwise(1)
    pair = _pair(place * 99 + _number(core, 5, 2) - 1, _number(core, 8, 4) - 1, "ssn", key)

    def spelled(p: Column) -> Column:
        place = F.floor(p["a"] / 99)
        area = place + F.when(place >= 665, 2).otherwise(1)
        return F.concat_ws("-", *(F.lpad(v.cast("int").cast("string"), n, "0") for v, n in ((area, 3), (p["a"] % 99 + 1, 2), (p["b"] + 1, 4))))

    return _bind(pair, spelled)


def _date(core: Column, key: str) -> Column:
    day = F.datediff(F.make_date(*_date_parts(core)), F.lit("1800-01-01").cast("date"))
    pair = _pair(F.floor(day / 773), day % 773, "date", key)

    def spelled(p: Column) -> Column:
        date = F.date_add(F.lit("1800-01-01").cast("date"), (p["a"] * 773 + p["b"]).cast("int"))
        y, m, d = (F.date_format(date, f) for f in ("yyyy", "MM", "dd"))
        mark = F.substring(core, 5, 1)
        return F.when(F.substring(core, 3, 1) == ".", F.concat_ws(".", d, m, y)).otherwise(F.concat(y, mark, m, mark, d))

    return _bind(pair, spelled)


def _pseudonym(item: Column, key: str) -> Column:
    """The item with its value permuted, or itself."""
    lead = F.regexp_extract(item, _LEAD, 0)

    def core_of(core: Column) -> Column:
        def by_kind(kind: Column) -> Column:
            moved = F.when(kind.isin("mail", "phone", "card"), _characters(core, kind, key))
            for name, fn in (("ip", _ip), ("ssn", _ssn), ("date", _date)):
                moved = moved.when(kind == name, fn(core, key))
            return F.struct(F.coalesce(moved, core).alias("text"), kind.isNotNull().alias("valid"))

        return _bind(_kind(core), by_kind)

    value = _bind(F.substr(item, F.length(lead) + 1, F.length(item)), core_of)
    return _bind(value, lambda v: F.struct(F.concat(lead, v["text"]).alias("text"), v["valid"].alias("valid")))


def pseudonymize(docs: DataFrame, key: str, text: str = "text", count: str = "n_private") -> DataFrame:
    """``docs`` with every validated value in ``text`` replaced under ``key``, and the number of them in ``count``.

    Null stays null with 0 found, an empty text stays empty. Repeated rows get the same
    result. A column that is called as ``count`` already is replaced, others pass through.
    """
    pattern = F.lit(_FOUND)
    has_digit = F.col(text).rlike("[0-9@]")
    items = F.when(has_digit, F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: _pseudonym(m, key)))
    docs = docs.drop(count)
    made = "_items"
    while made in docs.columns:
        made += "_"
    docs = docs.withColumn(made, items)
    between = F.split(F.col(text), _FOUND)
    joined = F.array_join(F.flatten(F.zip_with(between, F.col(made), lambda t, m: F.array(t, F.coalesce(m["text"], F.lit(""))))), "")
    found = F.coalesce(F.size(F.filter(made, lambda m: m["valid"])), F.lit(0))
    changed = F.size(made) > 0
    names = [F.when(changed, joined).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c != made]
    return docs.select(*names, F.when(changed, found).otherwise(0).cast("long").alias(count))


def oracle(key: str) -> str:
    """DuckDB SQL for ``doc_id, text, n_private`` of the whole table ``documents``."""
    whole = {n: f"regexp_full_match(core, '{p}')" for n, p in KINDS.items()}

    def luhn(digits: str) -> str:
        d = f"(substr({digits}, len({digits}) - i, 1)::INT * (1 + i % 2))"
        return f"((10 - coalesce(list_sum([{d} - CASE WHEN {d} > 9 THEN 9 ELSE 0 END FOR i IN range(1, len({digits}))]), 0) % 10) % 10)::INT"

    digits = "regexp_replace(core, '[^0-9]', '', 'g')"
    y = "CASE WHEN substr(core, 3, 1) <> '.' THEN substr(core, 1, 4)::INT ELSE substr(core, 7, 4)::INT END"
    m = "CASE WHEN substr(core, 3, 1) <> '.' THEN substr(core, 6, 2)::INT ELSE substr(core, 4, 2)::INT END"
    d = "CASE WHEN substr(core, 3, 1) <> '.' THEN substr(core, 9, 2)::INT ELSE substr(core, 1, 2)::INT END"
    month_end = f"CASE WHEN ({m}) IN (4, 6, 9, 11) THEN 30 WHEN ({m}) <> 2 THEN 31 WHEN ({y}) % 4 = 0 AND (({y}) % 100 <> 0 OR ({y}) % 400 = 0) THEN 29 ELSE 28 END"
    area, serial = "substr(core, 1, 3)::INT", "substr(core, 8, 4)::INT"
    valid = {
        "mail": "true",
        "phone": f"regexp_full_match({digits}, '1[0-9]{{10}}')",
        "ip": "list_max([x::INT FOR x IN string_split(core, '.')]) <= 255",
        "date": f"({y}) BETWEEN 1800 AND 2199 AND ({m}) BETWEEN 1 AND 12 AND ({d}) >= 1 AND ({d}) <= {month_end}",
        "ssn": f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND substr(core, 5, 2)::INT >= 1 AND {serial} >= 1",
        "card": f"{luhn(digits)} = right({digits}, 1)::INT",
    }
    kind = "CASE " + " ".join(f"WHEN {whole[n]} THEN CASE WHEN {valid[n]} THEN '{n}' END" for n in KINDS) + " END"
    nth = "len(regexp_replace(substr(core, 1, i), '[^0-9]', '', 'g'))"
    c = "substr(core, i, 1)"
    classes = f"""array_to_string([CASE
        WHEN kind = 'mail' THEN CASE WHEN i > strpos(core, '@') THEN 'f' WHEN {c} SIMILAR TO '[0-9]' THEN 'd' WHEN {c} SIMILAR TO '[a-z]' THEN 'l' WHEN {c} SIMILAR TO '[A-Z]' THEN 'u' ELSE 'f' END
        WHEN NOT {c} SIMILAR TO '[0-9]' OR {nth} = 1 THEN 'f'
        WHEN kind = 'phone' THEN CASE WHEN {nth} NOT IN (2, 5) THEN 'd' WHEN {c} >= '2' THEN 'n' ELSE 'b' END
        WHEN {nth} = len({digits}) THEN 'f' ELSE 'd' END FOR i IN range(1, len(core) + 1)], '')"""
    first = f"CASE kind WHEN 'ip' THEN p[1]::BIGINT * 256 + p[2]::BIGINT WHEN 'ssn' THEN ({area} - CASE WHEN {area} > 666 THEN 2 ELSE 1 END) * 99 + substr(core, 5, 2)::INT - 1 WHEN 'date' THEN (make_date({y}, {m}, {d}) - DATE '1800-01-01') // 773 END"
    second = f"CASE kind WHEN 'ip' THEN p[3]::BIGINT * 256 + p[4]::BIGINT WHEN 'ssn' THEN {serial} - 1 WHEN 'date' THEN (make_date({y}, {m}, {d}) - DATE '1800-01-01') % 773 END"
    a_size = "CASE kind " + " ".join(f"WHEN '{n}' THEN {s[0]}" for n, s in _SIZES.items()) + " ELSE 1 END"
    b_size = "CASE kind " + " ".join(f"WHEN '{n}' THEN {s[1]}" for n, s in _SIZES.items()) + " ELSE 1 END"
    steps = []
    for r in range(ROUNDS):
        other = "regexp_replace(s, '.(.?)', '\\1', 'g')" if r % 2 == 0 else "regexp_replace(s, '(.).?', '\\1', 'g')"
        chars = "('0x' || substr(h, 1 + 2 * ((i // 2) % 16), 2))::INT"
        one = "substr(s, i + 1, 1)"
        moved = " ".join(f"WHEN substr(cls, i + 1, 1) = '{n}' THEN chr((({base} + (ascii({one}) - {base} + {chars}) % {size}))::INT)" for n, base, size in (("d", 48, 10), ("n", 50, 8), ("b", 48, 2), ("l", 97, 26), ("u", 65, 26)))
        by = f"('0x' || substr(md5('{key}:' || kind || ':{r}:' || {'b' if r % 2 == 0 else 'a'}), 1, 8))::BIGINT"
        steps.append(
            f"h{r} AS (SELECT *, md5('{key}:' || kind || ':{r}:' || {other}) AS h FROM s{r}), "
            f"s{r + 1} AS (SELECT rid, n, lead, core, tail, kind, cls, array_to_string([CASE WHEN i % 2 <> {r % 2} THEN {one} {moved} ELSE {one} END FOR i IN range(0, len(s))], '') AS s, "
            + (f"(a + {by}) % ({a_size}) AS a, b" if r % 2 == 0 else f"a, (b + {by}) % ({b_size}) AS b")
            + f" FROM h{r})"
        )
    sdigits = "regexp_replace(s, '[^0-9]', '', 'g')"
    date = "(DATE '1800-01-01' + (a * 773 + b)::INT)"
    done = f"""CASE WHEN kind IN ('mail', 'phone') THEN s WHEN kind = 'card' THEN substr(s, 1, len(s) - 1) || {luhn(sdigits)}
        WHEN kind = 'ip' THEN concat_ws('.', a // 256, a % 256, b // 256, b % 256)
        WHEN kind = 'ssn' THEN concat_ws('-', lpad((a // 99 + CASE WHEN a // 99 >= 665 THEN 2 ELSE 1 END)::VARCHAR, 3, '0'), lpad((a % 99 + 1)::VARCHAR, 2, '0'), lpad((b + 1)::VARCHAR, 4, '0'))
        WHEN kind = 'date' THEN CASE WHEN substr(core, 3, 1) = '.' THEN strftime({date}, '%d.%m.%Y') ELSE replace(strftime({date}, '%Y-%m-%d'), '-', substr(core, 5, 1)) END
        ELSE core END"""
    pattern = PATTERN.replace("'", "''")
    return f"""WITH t AS (SELECT row_number() OVER () AS rid, doc_id, text, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS o FROM documents),
    i AS (SELECT rid, unnest(m) AS item, unnest(range(1, len(m) + 1)) AS n FROM t),
    l AS (SELECT rid, n, regexp_extract(item, '{_LEAD}') AS lead, item FROM i),
    v AS (SELECT rid, n, lead, substr(item, len(lead) + 1) AS item FROM l),
    c AS (SELECT rid, n, lead, CASE WHEN clock THEN left(item, len(item) - 3) ELSE item END AS core, CASE WHEN clock THEN right(item, 3) ELSE '' END AS tail
        FROM (SELECT *, regexp_full_match(item, '(?:{_DATE})T[0-9]{{2}}') AS clock FROM v)),
    k AS (SELECT *, {kind} AS kind, string_split(core, '.') AS p FROM c),
    s0 AS (SELECT rid, n, lead, core, tail, kind, CASE WHEN kind IN ('mail', 'phone', 'card') THEN {classes} ELSE repeat('f', len(core)) END AS cls, core AS s, ({first})::BIGINT AS a, ({second})::BIGINT AS b FROM k),
    {', '.join(steps)},
    f AS (SELECT rid, n, lead || {done} || tail AS item, kind FROM s{ROUNDS}),
    g AS (SELECT rid, list(item ORDER BY n) AS items, count(kind) AS found FROM f GROUP BY rid)
    SELECT doc_id, CASE WHEN g.rid IS NULL THEN text ELSE array_to_string([o[j] || coalesce(items[j], '') FOR j IN range(1, len(o) + 1)], '') END AS text, coalesce(found, 0)::BIGINT AS n_private
    FROM t LEFT JOIN g USING (rid)"""
