"""Fixed schemas. Addresses are unsigned 32-bit numbers, kept as BIGINT so that they sort as numbers."""

SESSIONS = (
    "start_time timestamp, end_time timestamp, router_ip bigint, router_port int, protocol_id smallint, "
    "private_ip bigint, private_port int, public_ip bigint, public_port int, destination_ip bigint, "
    "destination_port int, packet_size int"
)
SESSION_COLUMNS = [c.split()[0] for c in SESSIONS.split(", ")]
SESSIONS_V1 = (
    "event_time timestamp, start_time timestamp, end_time timestamp, event_id string, event_type string, "
    "header string, router_ip bigint, router_port int, protocol_id smallint, protocol string, private_ip bigint, "
    "private_port int, public_ip bigint, public_port int, destination_ip bigint, destination_port int, packet_size int"
)
PARTITIONS = ["event_date", "node"]
PACKETS = "packet_id bigint, received_s bigint, router_ip bigint, router_port int, payload binary"
RAW_PACKETS_JSON = "received_time string, router_ip string, router_port int, packet_size int, raw_hex string"
SIDECAR = "schema_version int, created_time string, table_name string, rows bigint, bytes bigint, format string, error string"
ALERTS = (
    "id string, hostname string, ip string, start_time timestamp, end_time timestamp, name string, threshold double, "
    "indicator double, state string, sent_at timestamp, version bigint"
)
