"""IP address validity and private ranges, IPv4 and IPv6, as native expressions.

An IPv4 address folds to a bigint, an IPv6 address to 32 hex digits; both then
compare against range bounds, so no Python runs per row.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from letterscope.functions.text import as_col, bind

# Fixed values -------------------------------------------------------------
PRIVATE_V4 = [
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
    "192.0.0.0/24", "192.0.0.170/31", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15",
    "198.51.100.0/24", "203.0.113.0/24", "240.0.0.0/4", "255.255.255.255/32",
]
PUBLIC_INSIDE_V4 = ["192.0.0.9/32", "192.0.0.10/32"]
PRIVATE_V6 = [
    "::1/128", "::/128", "64:ff9b:1::/48", "100::/64", "2001::/23",
    "2001:db8::/32", "2002::/16", "fc00::/7", "fe80::/10",
]
PUBLIC_INSIDE_V6 = [
    "2001:1::1/128", "2001:1::2/128", "2001:3::/32",
    "2001:4:112::/48", "2001:20::/28", "2001:30::/28",
]
# --------------------------------------------------------------------------

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = rf"^{_OCTET}([.]{_OCTET}){{3}}\z"
_MAPPED = "0" * 20 + "ffff"


def _within(value: Column, networks: list[str], show: Callable) -> Column:
    bounds = [ipaddress.ip_network(n) for n in networks]
    tests = [value.between(show(b.network_address), show(b.broadcast_address)) for b in bounds]
    return reduce(lambda a, b: a | b, tests)


def is_ipv4(address: Column | str) -> Column:
    return as_col(address).rlike(_V4)


def ipv4_number(address: Column | str) -> Column:
    """Valid dotted quad to its number, else null."""
    text = as_col(address)
    octets = F.split(text, "[.]")
    parts = [F.get(octets, F.lit(i)).cast("bigint") * F.lit(256 ** (3 - i)) for i in range(4)]
    return F.when(is_ipv4(text), reduce(lambda a, b: a + b, parts))


def _groups(half: Column) -> Column:
    return F.filter(F.split(half, ":", -1), lambda g: half != "")


def _quad_to_groups(text: Column) -> Column:
    """Rewrite a dotted tail as two hex groups; a bad tail gives null."""
    quad = F.substring_index(text, ":", -1)
    digits = F.lpad(F.lower(F.hex(ipv4_number(quad))), 8, "0")
    head = F.substring(text, F.lit(1), F.length(text) - F.length(quad))
    return F.concat(head, F.left(digits, F.lit(4)), F.lit(":"), F.right(digits, F.lit(4)))


def _spread(halves: Column) -> Column:
    """The eight groups of an address split at ``::``; null if there are not eight."""
    left = _groups(F.get(halves, F.lit(0)))
    right = F.when(F.size(halves) == 2, _groups(F.get(halves, F.lit(1)))).otherwise(
        F.array().cast("array<string>")
    )
    missing = F.lit(8) - F.size(left) - F.size(right)
    complete = F.when(F.size(halves) == 1, missing == 0).otherwise((F.size(halves) == 2) & (missing >= 1))
    return F.when(complete, F.concat(left, F.array_repeat(F.lit("0"), missing), right))


def ipv6_hex(address: Column | str) -> Column:
    """Valid IPv6 text to 32 lower-case hex digits, else null."""
    text = as_col(address)
    bare = F.lower(F.regexp_extract(text, r"^([0-9A-Fa-f:.]+)(%[^%]+)?\z", 1))
    plain = F.when(F.contains(bare, F.lit(".")), _quad_to_groups(bare)).otherwise(bare)
    groups = bind(F.split(plain, "::", -1), _spread)
    joined = bind(
        groups,
        lambda gs: F.when(
            F.forall(gs, lambda g: g.rlike(r"^[0-9a-f]{1,4}\z")),
            F.array_join(F.transform(gs, lambda g: F.lpad(g, 4, "0")), ""),
        ),
    )
    return F.when(F.contains(text, F.lit(":")), joined)


def is_ip(address: Column | str) -> Column:
    """Valid IPv4 or IPv6 text; null stays null."""
    text = as_col(address)
    v6 = F.when(F.contains(text, F.lit(":")), ipv6_hex(text).isNotNull()).otherwise(F.lit(False))
    return F.when(text.isNotNull(), is_ipv4(text) | v6)


def _private_number(number: Column) -> Column:
    def show(a: ipaddress.IPv4Address) -> Column:
        return F.lit(int(a))

    return bind(
        number, lambda n: _within(n, PRIVATE_V4, show) & ~_within(n, PUBLIC_INSIDE_V4, show)
    )


def _private_digits(digits: Column) -> Column:
    def show(a: ipaddress.IPv6Address) -> Column:
        return F.lit(f"{int(a):032x}")

    mapped = F.conv(F.right(digits, F.lit(8)), 16, 10).cast("bigint")
    return F.when(F.startswith(digits, F.lit(_MAPPED)), _private_number(mapped)).otherwise(
        _within(digits, PRIVATE_V6, show) & ~_within(digits, PUBLIC_INSIDE_V6, show)
    )


def is_private(address: Column | str) -> Column:
    """True or false for a valid address, null for anything else.

    An IPv4 address mapped into IPv6 gets the answer of the IPv4 address.
    """
    text = as_col(address)
    return F.when(F.contains(text, F.lit(":")), bind(ipv6_hex(text), _private_digits)).otherwise(
        _private_number(ipv4_number(text))
    )
