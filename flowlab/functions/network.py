"""Address and port classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Well-known ports by service, in the order that numbers the services from 1.
PORT_GROUPS: dict[str, list[int]] = {
    "web": [80, 443, 8080],
    "netbios": [137, 138, 139, 445],
    "ssh": [22],
    "ftp": [21],
    "ldap": [389, 3268],
    "ntp": [123],
    "udp": [53],
    "kerberos": [88],
    "smtp": [465],
    "rpc": [135],
    "dns": [5353],
}


def private_ip(address: Column) -> Column:
    """1 for 172.16-31.* and 192.168.*, 0 for every other text and for NULL."""
    octets = F.split(address, r"\.")
    first = F.get(octets, F.lit(0)).try_cast("int")
    second = F.get(octets, F.lit(1)).try_cast("int")
    private = ((first == 172) & second.between(16, 31)) | ((first == 192) & (second == 168))
    return F.when(private, 1).otherwise(0)


def port_id(port: Column, groups: Mapping[str, Sequence[int]] = PORT_GROUPS) -> Column:
    """Service number of a port, from 1 in the order of ``groups``; others 0, NULL stays NULL.

    The dictionary becomes one literal map, so the lookup is one expression however many
    groups there are. A port listed twice belongs to its first group.
    """
    ids: dict[int, int] = {}
    for number, ports in enumerate(groups.values(), start=1):
        for value in ports:
            ids.setdefault(value, number)
    if not ids:
        return F.when(port.isNotNull(), 0)
    # As doubles, so that a port with a fraction is no other port.
    table = F.create_map(*[F.lit(x) for value, number in ids.items() for x in (float(value), number)])
    found = F.try_element_at(table, port.try_cast("double"))
    return F.when(port.isNotNull(), F.coalesce(found, F.lit(0)))
