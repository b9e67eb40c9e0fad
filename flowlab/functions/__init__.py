"""Column expressions: everything here stays inside the JVM."""

from flowlab.functions.names import clean_name, quoted
from flowlab.functions.network import PORT_GROUPS, port_id, private_ip
from flowlab.functions.numbers import as_double, finite, is_numeric
from flowlab.functions.scores import argmax_class, log_softmax_loss, softmax

__all__ = [
    "PORT_GROUPS", "argmax_class", "as_double", "clean_name", "finite", "is_numeric",
    "log_softmax_loss", "port_id", "private_ip", "quoted", "softmax",
]
