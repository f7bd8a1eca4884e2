"""R-4 and the md5 fold of R-5 as native Column expressions.

murmur2 (the Kafka client's key hash) is evaluated with higher-order
functions over the key's UTF-8 bytes (taken from ``hex(key)``), all in
64-bit arithmetic masked to 32 bits: a 32-bit value times the 31-bit
multiplier stays below 2^63, so no step overflows.  No Python UDF is
involved; higher-order functions are evaluated outside whole-stage code
generation, on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide import schemas as S

_M = S.MURMUR2_M
_MASK = 0xFFFFFFFF


def _byte(hx: str, j: str) -> str:
    return f"cast(conv(substr({hx}, 2 * ({j}) + 1, 2), 16, 10) as bigint)"


def _let(name: str, value: str, body: str) -> str:
    """Bind ``value`` once (a one-element ``transform``) so the SQL stays
    linear in size and each step is evaluated once per row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def murmur2_sql(key_sql: str) -> str:
    """Spark SQL text of the positive 31-bit murmur2 of a string key."""
    hx = "mm_hx"
    n = f"(length({hx}) div 2)"
    n4 = f"({n} div 4)"
    t = f"({n4} * 4)"
    rem = f"({n} % 4)"
    blocks = f"if({n4} > 0, sequence(0, {n4} - 1), cast(array() as array<int>))"
    k = (f"transform({blocks}, i -> {_byte(hx, '4 * i')} | shiftleft({_byte(hx, '4 * i + 1')}, 8)"
         f" | shiftleft({_byte(hx, '4 * i + 2')}, 16) | shiftleft({_byte(hx, '4 * i + 3')}, 24))")
    mix = f"(mm_k0 * {_M}) & {_MASK}"
    mixed = f"transform({k}, mm_k0 -> {_let('mm_k1', mix, f'((mm_k1 ^ shiftright(mm_k1, {S.MURMUR2_R})) * {_M}) & {_MASK}')})"
    h0 = f"(({S.MURMUR2_SEED} ^ {n}) & {_MASK})"
    body = f"aggregate({mixed}, {h0}, (h, k) -> ((h * {_M}) & {_MASK}) ^ k)"
    tail2 = (f"mm_b ^ if({rem} >= 3, shiftleft({_byte(hx, t + ' + 2')}, 16), 0)"
             f" ^ if({rem} >= 2, shiftleft({_byte(hx, t + ' + 1')}, 8), 0)")
    tail1 = f"if({rem} >= 1, ((mm_t2 ^ {_byte(hx, t)}) * {_M}) & {_MASK}, mm_t2)"
    fin = _let("mm_f1", f"(mm_t1 ^ shiftright(mm_t1, 13)) * {_M} & {_MASK}",
               f"(mm_f1 ^ shiftright(mm_f1, 15)) & {0x7FFFFFFF}")
    expr = _let("mm_b", body, _let("mm_t2", tail2, _let("mm_t1", tail1, fin)))
    full = _let(hx, f"hex(encode({key_sql}, 'UTF-8'))", expr)
    return f"if({key_sql} is null, cast(null as bigint), {full})"


def murmur2(key: Column | str) -> Column:
    """Positive murmur2 hash of a string key (null key -> null)."""
    name = key if isinstance(key, str) else None
    if name is None:
        raise TypeError("pass the key as a column name")
    return F.expr(murmur2_sql(f"`{name}`"))


def md5_mod(key: str, n: Column) -> Column:
    """``int(md5(key), 16) % n`` for n < 2^31: the 128-bit digest folded as
    four 32-bit words, ``acc = (acc * 2^32 + word) % n``."""
    words = [F.conv(F.substring(F.md5(F.col(key)), 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    acc = F.lit(0).cast("long")
    for w in words:
        acc = F.pmod(acc * F.lit(1 << 32) + w, n.cast("long"))
    return acc
