"""Log lines for tests."""

from __future__ import annotations

# A line in the published format, one field per name, in line order.
FIELDS = {
    "version": "1",
    "msec": "1568962563.374",
    "vhost": "www.example.org",
    "protocol": "s",
    "loctag": "ws",
    "status": "200",
    "bytes_sent": "2799",
    "gzip_ratio": "2.5",
    "request_length": "289",
    "request_time": "0.026",
    "upstream_addr": "192.0.2.31:8080",
    "upstream_status": "200",
    "upstream_response_time": "0.024",
    "upstream_connect_time": "0.000",
    "upstream_header_time": "0.024",
}


def line(**changed) -> str:
    return "|".join(str(v) for v in {**FIELDS, **changed}.values())


def upstream_line(addr, status="200", response="0.1", connect="0.2", header="0.3", **changed) -> str:
    return line(
        upstream_addr=addr,
        upstream_status=status,
        upstream_response_time=response,
        upstream_connect_time=connect,
        upstream_header_time=header,
        **changed,
    )


def bare_line(msec, **changed) -> str:
    """A line without upstream at the given time."""
    return line(msec=msec, upstream_addr="-", **changed)
