"""Spark's xxhash64 of whole numbers, spelled out as DuckDB SQL.

Used to check hash-derived columns. The algorithm is the public XXH64; its
multiplications wrap at 64 bits and are done here in 128-bit unsigned numbers.
"""

P1 = 0x9E3779B185EBCA87
P2 = 0xC2B2AE3D27D4EB4F
P3 = 0x165667B19E3779F9
P4 = 0x85EBCA77C2B2AE63
P5 = 0x27D4EB2F165667C5
WRAP = 2**64
SPARK_SEED = 42


def big(n: int) -> str:
    return f"'{n}'::uhugeint"


def wrap(x: str) -> str:
    return f"(({x}) % {big(WRAP)})"


def times(x: str, p: int) -> str:
    return wrap(f"{x} * {big(p)}")


def rotl(x: str, r: int) -> str:
    return f"({wrap(f'{x} * {big(2**r)}')} + {x} // {big(2 ** (64 - r))})"


def unsigned(x: str) -> str:
    return f"(case when {x} < 0 then ({x}::hugeint + '{WRAP}'::hugeint) else {x}::hugeint end)::uhugeint"


def signed(x: str) -> str:
    return f"(case when {x} >= {big(2**63)} then {x}::hugeint - '{WRAP}'::hugeint else {x}::hugeint end)::bigint"


FINISH = [
    lambda h: f"xor({h}, {h} // {big(2**33)})",
    lambda h: times(h, P2),
    lambda h: f"xor({h}, {h} // {big(2**29)})",
    lambda h: times(h, P3),
    lambda h: f"xor({h}, {h} // {big(2**32)})",
]


def int_steps(value: int) -> list:
    """Steps that fold a 32-bit literal into the running hash."""
    mixed = value % 2**32 * P1 % WRAP
    return [
        lambda h: wrap(f"{h} + {big(P5 + 4)}"),
        lambda h: f"xor({h}, {big(mixed)})",
        lambda h: wrap(f"{times(rotl(h, 23), P2)} + {big(P3)}"),
        *FINISH,
    ]


def long_steps(value: str) -> list:
    """Steps that fold a 64-bit column into the running hash."""
    scrambled = times(rotl(times(unsigned(value), P2), 31), P1)
    return [
        lambda h: wrap(f"{h} + {big(P5 + 8)}"),
        lambda h: f"xor({h}, {scrambled})",
        lambda h: wrap(f"{times(rotl(h, 27), P1)} + {big(P4)}"),
        *FINISH,
    ]


def advance(source: str, columns: dict[str, list]) -> str:
    """Apply each column's step list, one nested select per step."""
    depth = max(len(steps) for steps in columns.values())
    sql = source
    for i in range(depth):
        moves = ", ".join(
            f"{steps[i](name)} as {name}" for name, steps in columns.items() if i < len(steps)
        )
        sql = f"select * replace ({moves}) from ({sql})"
    return sql


def draws(source: str, key: str, salts: dict[str, tuple[int, int]]) -> str:
    """``source`` with a column per salt: the hash of (key, salt) modulo a limit."""
    seeded = f"select *, {big(SPARK_SEED)} as _h from ({source})"
    keyed = advance(seeded, {"_h": long_steps(key)})
    names = {name: salt for name, (salt, _) in salts.items()}
    spread = f"select *, {', '.join(f'_h as _{n}' for n in names)} from ({keyed})"
    hashed = advance(spread, {f"_{n}": int_steps(salt) for n, salt in names.items()})
    slots = ", ".join(
        f"(({signed(f'_{n}')}::hugeint % {limit} + {limit}) % {limit})::bigint as {n}"
        for n, (_, limit) in salts.items()
    )
    inner = ", ".join(["_h", *[f"_{n}" for n in names]])
    return f"select * exclude ({inner}), {slots} from ({hashed})"


def hash_of(source: str, keys: list[str], name: str) -> str:
    """``source`` with the signed hash of its whole-number columns ``keys``."""
    sql = f"select *, {big(SPARK_SEED)} as _h from ({source})"
    for key in keys:
        sql = advance(sql, {"_h": long_steps(key)})
    return f"select * exclude (_h), {signed('_h')} as {name} from ({sql})"
