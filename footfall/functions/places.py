"""Positions and addresses as integers and cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard geohash alphabet and the dotted-quad pattern.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
IPV4_PATTERN = r"^((25[0-5]|2[0-4]\d|[01]?\d?\d)\.){3}(25[0-5]|2[0-4]\d|[01]?\d?\d)$"


def _pair_letters() -> str:
    """Letter for 3 bits of one axis and 2 bits of the other, the 3-bit axis leading: index 4*a + b."""

    def letter(a: int, b: int) -> str:
        bits = [a >> 2 & 1, b >> 1 & 1, a >> 1 & 1, b & 1, a & 1]
        return GEOHASH_ALPHABET[int("".join(map(str, bits)), 2)]

    return "".join(letter(a, b) for a in range(8) for b in range(4))


def geohash6_sql(latitude: str, longitude: str) -> str:
    """SQL text of the 6-letter geohash of two SQL expressions.

    Both axes are cut into 2^15 cells.  360/2^15 is 45/4096, so scaling by a power of two and one
    division by 45 places every double in its exact cell.
    """
    lng = f"least(cast(floor({longitude} * 4096 / 45D) as int) + 16384, 32767)"
    lat = f"least(cast(floor({latitude} * 8192 / 45D) as int) + 16384, 32767)"
    letters = _pair_letters()

    def pick(major: str, major_shift: int, minor: str, minor_shift: int) -> str:
        return (
            f"substr('{letters}', (shiftright({major}, {major_shift}) & 7) * 4"
            f" + (shiftright({minor}, {minor_shift}) & 3) + 1, 1)"
        )

    word = ", ".join(
        [
            pick(lng, 12, lat, 13),
            pick(lat, 10, lng, 10),
            pick(lng, 7, lat, 8),
            pick(lat, 5, lng, 5),
            pick(lng, 2, lat, 3),
            pick(lat, 0, lng, 0),
        ]
    )
    return (
        f"case when {latitude} between -90 and 90 and {longitude} between -180 and 180"
        f" then concat({word}) end"
    )


def geohash6(latitude: str, longitude: str) -> Column:
    """6-letter geohash of two columns, null outside the globe or for null input."""
    return F.expr(geohash6_sql(latitude, longitude))


def ipv4_to_long(ip: Column | str) -> Column:
    """Dotted quad to a 32-bit number held in a bigint; null for anything else."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    octets = [
        F.substring_index(F.substring_index(ip, ".", i), ".", -1).try_cast("bigint") for i in range(1, 5)
    ]
    value = octets[0] * 2**24 + octets[1] * 2**16 + octets[2] * 2**8 + octets[3]
    return F.when(ip.rlike(IPV4_PATTERN), value)
