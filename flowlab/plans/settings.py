"""Settings of the layer pipeline; the defaults fit the public DDoS flow captures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

from flowlab.functions.network import PORT_GROUPS


@dataclass(frozen=True)
class EtlSettings:
    """Column roles by layer. Raw names are those of the files, later ones are cleaned."""

    # The names and roles of the columns of the capture files.
    # Raw layer. Without a target nothing is balanced: that is the prediction path.
    target: str | None = " Label"
    ignore_labels: Sequence[str] = ("UDPLag",)
    raw_drop: Sequence[str] = ("SimilarHTTP",)
    # Columns that tell the rows apart; None draws a Bernoulli sample instead of an exact one.
    balance_key: Sequence[str] | None = None
    seed: int = 2
    schema: T.StructType | None = None
    extension: str = "csv"
    # Staging layer.
    filter_columns: Sequence[str] = ("Protocol",)
    staging_drop: Sequence[str] = ("Unnamed:_0", "Flow_ID", "Timestamp")
    fill_max: Sequence[str] = ("Flow_Packets/s", "Flow_Bytes/s")
    drop_constants: bool = True
    # Business layer.
    ip_columns: Sequence[str] = ("Source_IP", "Destination_IP")
    index_columns: Sequence[tuple[str, str]] = (
        ("Protocol", "Protocal_Index"), ("Label", "Label_Index"),
    )
    port_columns: Sequence[str] = ("Source_Port", "Destination_Port")
    ports: Mapping[str, Sequence[int]] = field(default_factory=lambda: dict(PORT_GROUPS))
    # Training set.
    label_index: str = "Label_Index"
    categorical: Sequence[str] = ("Label_Index", "Source_Port", "Destination_Port")
    components: int = 6
