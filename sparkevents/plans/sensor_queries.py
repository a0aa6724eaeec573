"""Queries over endpoint-sensor events: environment, dispatch, one builder per family, the whole path, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, sensor
from ..operators.sensor import Options
from ..sources import frames
from .carriers import Duck, guid_sql
from .registry import Tables, plain, query

URL = "https://console.example.org/"
SERVER = "server-1"
OPTIONS = Options(SERVER, URL)
ALL_TYPES = [sensor.PREFIX + t for _, _, types in sensor.FAMILIES.values() for t in types]
SOME_TYPES = [sensor.PREFIX + t for t in ("procstart", "filemod", "netconn", "tamper", "processblock", "remotethread")]

FAM = {
    "process": "fam IN (0, 15)", "modload": "fam = 1", "filemod": "fam = 2", "netconn_v2": "fam = 3", "netconn_v1": "fam = 4",
    "regmod": "fam = 5", "childproc": "fam = 6", "crossproc": "fam = 7", "emet": "fam = 8", "script": "fam = 9",
    "tamper": "fam = 10", "blocked": "fam = 11", "module": "fam = 12",
}


# ---- the expected columns in SQL, by name ----------------------------------------------------------------------------


def _big(x: str) -> str:
    return f"cast({x} AS BIGINT)"


def _seconds(t: str) -> str:
    return f"CASE WHEN coalesce({t}, 0) = 0 THEN 0 ELSE (({t} // 10000) - 11644473600000) // 1000 END"


def _little_endian(v: str) -> str:
    return " || '.' || ".join(f"cast(({v} >> {s}) & 255 AS VARCHAR)" for s in (0, 8, 16, 24))


def _swap(p: str) -> str:
    return f"((({p}) >> 8) & 255) | ((({p}) & 255) << 8)"


def _link(*parts: str) -> str:
    return f"'{URL}' || " + " || ".join(parts)


def _names(value: str, texts: dict[int, str], other: str) -> str:
    return "CASE " + value + " " + " ".join(f"WHEN {n} THEN '{t}'" for n, t in texts.items()) + f" ELSE {other} END"


def _unknown(value: str) -> str:
    return f"'unknown (' || cast({value} AS VARCHAR) || ')'"


SENSOR = "coalesce(sensor, 0)"
PROCESS_GUID = (
    f"CASE WHEN h_pid IS NOT NULL AND h_ct IS NOT NULL AND sensor IS NOT NULL THEN {guid_sql(Duck, 'sensor', 'h_pid', 'h_ct')}"
    " ELSE cast(h_guid AS VARCHAR) END"
)
HEAD_MD5, HEAD_SHA = "upper(h_md5)", "upper(h_sha)"
OWN_MD5, OWN_SHA = "CASE WHEN has_own THEN upper(own_md5) END", "CASE WHEN has_own THEN upper(own_sha) END"
SMALL5 = "CASE WHEN small % 5 = 0 THEN 1 ELSE 1 << (small % 5 - 1) END"
PATH = "coalesce(path, '')"
H_PATH = "coalesce(h_path, '')"


def base_sql(kind: str, event_type: str) -> dict[str, str]:
    return {
        "timestamp": _big(_seconds("h_ts")), "cb_server": f"'{SERVER}'", "type": f"'ingress.event.' || {kind}",
        "sensor_id": _big(SENSOR), "computer_name": "host", "event_type": f"'{event_type}'",
    }


MESSAGE_SQL = {
    "fork_pid": _big("nullif(h_fork, 0)"), "pid": _big("nullif(h_pid, 0)"), "process_guid": PROCESS_GUID,
    "link_process": _link("'#analyze/'", f"({PROCESS_GUID})", "'/0'"),
    "link_sensor": _link("'#/host/'", f"cast({SENSOR} AS VARCHAR)"), "process_path": "h_path",
}
HASH_SQL = {"sha256": HEAD_SHA, "md5": HEAD_MD5}

PARENT_GUID = (
    f"CASE WHEN sensor IS NOT NULL AND even AND h_ct IS NOT NULL THEN {guid_sql(Duck, 'sensor', 'user_id', 'h_ct')}"
    " ELSE cast(h_guid AS VARCHAR) END"
)
CHILD_GUID = (
    f"CASE WHEN small <> 6 AND sensor IS NOT NULL THEN {guid_sql(Duck, 'sensor', 'event_id * 9', 'win - 5')}"
    " ELSE cast(h_guid + 1 AS VARCHAR) END"
)
CHILD_PARENT = (
    f"CASE WHEN h_ct IS NOT NULL AND h_pid IS NOT NULL THEN {guid_sql(Duck, SENSOR, 'h_pid', 'h_ct')}"
    " ELSE cast(h_guid AS VARCHAR) END"
)
TARGET_GUID = guid_sql(Duck, SENSOR, "ip_a", "win")
BLOCKED_GUID = guid_sql(Duck, SENSOR, "h_pid", "win")
HAS_BLOCKED_PID = "has_own AND h_pid IS NOT NULL"

def _ipv6_sql() -> str:
    """fe80:0:0:0 followed by the four groups of ``ip_b << 16``: the first of which is always zero."""
    # The low half's bytes, lowest first, are 00 00 b0 b1 b2 b3 00 00: groups 0, b0b1, b2b3, 0.
    g1 = "((ip_b & 255) * 256 + ((ip_b >> 8) & 255))"
    g2 = "(((ip_b >> 16) & 255) * 256 + ((ip_b >> 24) & 255))"
    hex_of = lambda g: f"printf('%x', cast({g} AS BIGINT))"
    text = (
        f"CASE WHEN {g1} = 0 AND {g2} = 0 THEN 'fe80::' WHEN {g1} = 0 THEN 'fe80::' || {hex_of(g2)} || ':0'"
        f" ELSE 'fe80::' || {hex_of(g1)} || ':' || {hex_of(g2)} || ':0' END"
    )
    scope = "CASE WHEN small = 4 THEN '%eth0' ELSE '' END"
    return f"CASE WHEN even THEN {text} || {scope} ELSE {_little_endian('ip_a')} END"


FAMILY_SQL: dict[str, dict[str, str]] = {
    "process": {
        **base_sql("CASE WHEN fam = 0 THEN 'procstart' ELSE 'procend' END", "proc"), **MESSAGE_SQL, "path": PATH,
        "md5": f"CASE WHEN fam = 0 THEN coalesce({OWN_MD5}, {HEAD_MD5}, '') ELSE '' END",
        "sha256": f"CASE WHEN fam = 0 THEN coalesce({OWN_SHA}, {HEAD_SHA}, '') ELSE '' END",
        "command_line": "text", "parent_path": H_PATH, "parent_pid": _big("CASE WHEN even THEN user_id ELSE 0 END"),
        "parent_guid": _big("h_guid"), "parent_create_time": _big(_seconds("h_ct")), "filtering_known_dlls": "false",
        "parent_md5": OWN_MD5, "parent_sha256": OWN_SHA, "expect_followon_w_md5": "small > 9",
        "link_parent": _link("'#analyze/'", f"({PARENT_GUID})", "'/1'"), "username": "h_path",
        "uid": "CASE WHEN has_own THEN '0' END",
    },
    "modload": {
        **base_sql("'moduleload'", "modload"), **MESSAGE_SQL, "path": PATH, "md5": f"coalesce({OWN_MD5}, {HEAD_MD5}, '')",
        "sha256": f"coalesce({OWN_SHA}, {HEAD_SHA}, '')", "command_line": "''",
    },
    "filemod": {
        **base_sql("'filemod'", "filemod"), **MESSAGE_SQL, **HASH_SQL, "path": PATH, "tamper_sent": "false",
        "tamper": "small > 9", "file_sha256": OWN_SHA, "file_md5": OWN_MD5,
        "filetype_name": _names("small % 4", {0: "Unknown", 1: "Pe", 2: "Elf", 3: "UniversalBin"}, "NULL"),
        "action_type": _big(SMALL5),
        "action": _names(SMALL5, {1: "create", 2: "write", 4: "delete", 8: "lastwrite"}, "'?'"),
        "file_type": _big("small % 4"),
    },
    "netconn_v2": {
        **base_sql("'netconn'", "netconn"), **MESSAGE_SQL, **HASH_SQL,
        "protocol": _big("CASE WHEN small > 9 THEN 17 ELSE 6 END"), "domain": "text",
        "direction": "CASE WHEN small <= 4 OR small > 9 THEN 'outbound' ELSE 'inbound' END",
        "local_ip": _little_endian("ip_a"), "local_port": _big(_swap("port_b")), "remote_ip": _ipv6_sql(),
        "remote_port": _big(_swap("port_a")), "proxy": "small > 13",
        "proxy_ip": f"CASE WHEN small > 13 THEN {_little_endian('ip_b')} ELSE '' END",
        "proxy_port": _big(f"nullif(CASE WHEN small > 13 THEN {_swap('port_b')} ELSE 0 END, 0)"),
        "proxy_domain": "CASE WHEN small > 13 THEN text ELSE '' END", "ja3": "h_path", "ja3s": "NULL::VARCHAR",
    },
    "netconn_v1": {
        **base_sql("'netconn'", "netconn"), **MESSAGE_SQL, **HASH_SQL,
        "remote_port": _big(f"nullif(CASE WHEN has_own THEN {_swap('port_a')} ELSE 0 END, 0)"),
        "local_ip": f"CASE WHEN NOT has_own THEN {_little_endian('ip_b')} END",
        "local_port": _big(f"nullif(CASE WHEN NOT has_own THEN {_swap('port_b')} ELSE 0 END, 0)"),
        "direction": "CASE WHEN small > 9 THEN 'outbound' ELSE 'inbound' END", "domain": "text",
        "protocol": _big("CASE WHEN small > 9 THEN 17 ELSE 6 END"), "port": _big(_swap("port_a")),
        "ipv4": _little_endian("ip_a"), "remote_ip": f"CASE WHEN has_own THEN {_little_endian('ip_a')} END",
    },
    "regmod": {
        **base_sql("'regmod'", "regmod"), **MESSAGE_SQL, **HASH_SQL, "path": "text",
        "action": _names(SMALL5, {1: "createkey", 2: "writeval", 4: "delkey", 8: "delval"}, "'?'"),
        "action_type": _big(SMALL5), "tamper_sent": "true", "tamper": "small > 9",
    },
    "childproc": {
        **base_sql("'childproc'", "childproc"), **MESSAGE_SQL, "parent_guid": CHILD_PARENT,
        "link_child": _link("'#analyze/'", f"({CHILD_GUID})", "'/1'"), "created": "small > 4", "tamper_sent": "false",
        "tamper": "false", "path": H_PATH, "md5": f"coalesce({OWN_MD5}, {HEAD_MD5}, '')",
        "sha256": f"coalesce({OWN_SHA}, {HEAD_SHA}, '')",
        "childproc_type": _names("small % 4", {0: "Exec", 1: "Fork", 2: "OtherExec"}, "''"),
        "childproc_suppressed": "small > 9", "childproc_commandline": "CASE WHEN small > 9 THEN text END",
        "childproc_username": "CASE WHEN small > 9 THEN h_path END",
        "child_pid": _big("CASE WHEN small <> 6 THEN event_id * 9 ELSE 0 END"),
    },
    "crossproc": {
        **base_sql("CASE WHEN user_id % 2 = 0 THEN 'crossprocopen' ELSE 'remotethread' END", "cross_process"),
        **MESSAGE_SQL, **HASH_SQL, "is_target": "small > 9",
        "cross_process_type": "CASE WHEN user_id % 2 = 1 THEN 'remote_thread' ELSE "
        + _names("small % 4", {1: "open_process", 2: "open_thread"}, _unknown("small % 4")) + " END",
        "target_md5": f"coalesce({OWN_MD5}, '')",
        "requested_access": _big("CASE WHEN user_id % 2 = 0 THEN nullif(small * 100, 0) END"),
        "link_target": _link("'#analyze/'", TARGET_GUID, "'/1'"), "target_path": H_PATH,
        "target_sha256": f"coalesce({OWN_SHA}, '')", "target_pid": _big("ip_a"), "target_create_time": _big("win"),
        "target_process_guid": TARGET_GUID,
    },
    "emet": {
        **base_sql("'emetmitigation'", "emet_mitigation"), **MESSAGE_SQL, **HASH_SQL, "log_message": "text",
        "mitigation": _names("small + 1", {
            1: "Dep", 2: "Sehop", 3: "Asr", 4: "Aslr", 5: "NullPage", 6: "HeapSpray", 7: "MandatoryAslr", 8: "Eaf",
            9: "EafPlus", 10: "BottomUpAslr", 11: "LoadLibrary", 12: "MemoryProtection", 13: "SimulateExecFlow",
            14: "StackPivot", 15: "CallerChecks", 16: "BannedFunctions", 17: "DeepHooks", 18: "AntiDetours",
        }, _unknown("small + 1")),
        "blocked": "small > 9", "emet_timestamp": _big("win"), "log_id": _big("event_id"),
    },
    "script": {
        **base_sql("'filelessscriptload'", "filelessscriptload"), **MESSAGE_SQL, **HASH_SQL, "script_sha256": "own_sha",
        "script": "text",
    },
    "tamper": {
        **base_sql("'tamper'", "tamper"),
        "tamper_type": _names("small % 7", {
            1: "CoreDriverUnloaded", 2: "NetworkDriverUnloaded", 3: "CbServiceStopped", 4: "CbProcessTerminated",
            5: "CbCodeInjection",
        }, _unknown("small % 7")),
    },
    "blocked": {
        **base_sql("'processblocked'", "blocked_process"), "md5": f"coalesce({OWN_MD5}, '')", "path": H_PATH,
        "link_target": f"CASE WHEN {HAS_BLOCKED_PID} THEN " + _link("'#analyze/'", BLOCKED_GUID, "'/1'") + " END",
        "process_guid": f"CASE WHEN {HAS_BLOCKED_PID} THEN {BLOCKED_GUID} END",
        "process_create_time": _big(f"CASE WHEN {HAS_BLOCKED_PID} THEN win END"), "command_line": "text",
        "pid": _big(f"CASE WHEN {HAS_BLOCKED_PID} THEN nullif(h_pid, 0) END"),
        "uid": "CASE WHEN small % 3 = 0 AND small % 8 = 0 THEN host END",
        "username": "CASE WHEN small % 3 = 0 AND small % 8 = 0 THEN h_path END",
        "blocked_error": _big("CASE WHEN small % 8 IN (5, 6) THEN nullif(user_id, 0) END"),
        "blocked_event": _names("small % 3 + 1", {1: "ProcessCreate", 2: "RunningProcess"}, _unknown("small % 3 + 1")),
        "blocked_reason": "'Md5Hash'",
        "blocked_result": _names("small % 8", {
            0: "ProcessTerminated", 1: "NotTerminatedCBProcess", 2: "NotTerminatedSystemProcess",
            3: "NotTerminatedCriticalSystemProcess", 4: "NotTerminatedWhitelistPath",
            5: "NotTerminatedOpenProcessError", 6: "NotTerminatedTerminateError",
        }, _unknown("small % 8")),
    },
    "module": {
        **base_sql("'module'", "binary_info"), "digsig_result": "text", "digsig_publisher": "host",
        "digsig_program_name": "''", "digsig_issuer_name": "''", "digsig_result_code": "''", "digsig_subject_name": "''",
        "digsig_sign_time": "''", "utf_8_copied_module_length": _big("ip_a"), "utf_8_file_description": "text",
        "utf_8_company_name": "host", "utf_8_comments": "''", "utf_8_file_version": "''", "utf_8_legal_copyright": "''",
        "utf_8_legal_trademark": "''", "utf_8_internal_name": "''", "utf_8_product_name": H_PATH,
        "utf_8_original_file_name": "''", "utf_8_product_description": "''", "utf_8_product_version": "''",
        "utf_8_special_build": "''", "utf_8_on_disk_filename": "''", "utf_8_private_build": "''",
        "image_file_header": "''", "icon": "CASE WHEN has_own THEN to_base64(encode(text)) ELSE '' END",
        "size": _big("win"), "sha256": "upper(own_sha)", "md5": "upper(own_md5)",
    },
}


def _select(columns: dict[str, str], where: str, more: str = "event_id") -> str:
    listed = ", ".join([more] + [f"{c} AS {k}" for k, c in columns.items()])
    return f"SELECT {listed} FROM sensor_flat WHERE {where}"


# ---- shared parts ----------------------------------------------------------------------------------------------------


def events_with_env(t: Tables):
    return sensor.fill_env(t.sensor_events())


@query(
    "fill_env",
    """SELECT event_id, cast(sensor AS BIGINT) AS sensor_id, host AS computer_name, cast(user_id AS BIGINT) AS host_id,
              NULL::VARCHAR AS error FROM sensor_flat""",
    ("sensor_flat",),
)
def fill_env(t: Tables):
    e = F.col("env")["endpoint"]
    return events_with_env(t).select(
        "event_id", e["SensorId"].cast("bigint").alias("sensor_id"), e["SensorHostName"].alias("computer_name"),
        e["HostId"].alias("host_id"), "error",
    )


@query(
    "base_columns",
    _select({**base_sql("'netconn'", "netconn"), "timestamp_ms": _big("CASE WHEN h_ts = 0 THEN 0 ELSE (h_ts // 10000) - 11644473600000 END")}, "true"),
    ("sensor_flat",),
)
def base_columns(t: Tables):
    from ..functions.scalars import unix_seconds_float

    values = sensor.base_columns(OPTIONS, "netconn", "netconn")
    values["timestamp_ms"] = F.floor(unix_seconds_float(sensor.header("timestamp")) * 1000 + 0.0005)
    return plain(events_with_env(t).select("event_id", *[c.alias(k) for k, c in values.items()]))


@query("event_message_columns", _select(MESSAGE_SQL, "true"), ("sensor_flat",))
def event_message_columns(t: Tables):
    values = sensor.event_message_columns(OPTIONS)
    shown = {k: F.when(c != (0 if k in sensor.NUMERIC_OMITTED else ""), c) for k, c in values.items()}
    return plain(events_with_env(t).select("event_id", *[c.alias(k) for k, c in shown.items()]))


@query(
    "header_hash_columns",
    _select({"sha256": f"coalesce({HEAD_SHA}, '')", "md5": f"coalesce({HEAD_MD5}, '')"}, "true"),
    ("sensor_flat",),
)
def header_hash_columns(t: Tables):
    return t.sensor_events().select("event_id", *[c.alias(k) for k, c in sensor.header_hash_columns().items()])


@query(
    "hash_or_header",
    _select({"md5": f"coalesce({OWN_MD5}, {HEAD_MD5}, '')", "sha256": f"coalesce({OWN_SHA}, {HEAD_SHA}, '')"}, "fam = 1"),
    ("sensor_flat",),
)
def hash_or_header(t: Tables):
    own = F.col("modload")
    return t.sensor_events().filter("modload is not null").select(
        "event_id",
        sensor.hash_or_header(own["md5hash"], "md5").alias("md5"),
        sensor.hash_or_header(own["sha256hash"], "sha256").alias("sha256"),
    )


# ---- dispatch and filters --------------------------------------------------------------------------------------------

FAMILY_CASE = (
    "CASE " + " ".join(f"WHEN {w} THEN '{f}'" for f, w in FAM.items() if f != "tamper") + " WHEN fam = 10 THEN 'tamper' END"
)


@query("dispatch_family", f"SELECT event_id, {FAMILY_CASE} AS family FROM sensor_flat", ("sensor_flat",))
def dispatch_family(t: Tables):
    return sensor.dispatch_family(t.sensor_events()).select("event_id", "family")


@query(
    "event_enabled_filter",
    f"""SELECT event_id, {FAMILY_CASE} AS family FROM sensor_flat
        WHERE {FAMILY_CASE} IN ('process', 'filemod', 'netconn_v1', 'netconn_v2', 'tamper', 'blocked')""",
    ("sensor_flat",),
)
def event_enabled_filter(t: Tables):
    return sensor.event_enabled_filter(t.sensor_events(), SOME_TYPES).select("event_id", "family")


@query(
    "event_enabled_filter_strict",
    f"""SELECT event_id, {FAMILY_CASE} AS family FROM sensor_flat
        WHERE ({FAMILY_CASE} IN ('process', 'filemod', 'netconn_v1', 'netconn_v2', 'tamper', 'blocked') AND fam <> 15)
           OR (fam = 7 AND user_id % 2 = 1)""",
    ("sensor_flat",),
)
def event_enabled_filter_strict(t: Tables):
    rows = sensor.event_enabled_filter(t.sensor_events(), SOME_TYPES, strict_procend=True, strict_crossproc=True)
    return rows.select("event_id", "family")


@query("procend_filter", "SELECT event_id FROM sensor_flat WHERE fam <> 15", ("sensor_flat",))
def procend_filter(t: Tables):
    return sensor.procend_filter(t.sensor_events(), SOME_TYPES).select("event_id")


# ---- one query per family --------------------------------------------------------------------------------------------


def _family_query(family: str) -> None:
    @query(f"build_{family}", _select(FAMILY_SQL[family], FAM[family]), ("sensor_flat",))
    def run(t: Tables):
        rows = sensor.build(events_with_env(t), family, OPTIONS, keep=("event_id",))
        return plain(rows)


for _family in sensor.FAMILIES:
    _family_query(_family)


BLOCKED_V1 = {
    **base_sql("'netconnblocked'", "blocked_netconn"), "remote_port": _big(_swap("port_b")), "local_ip": "''",
    "local_port": "0::BIGINT", "direction": "'outbound'", "domain": "text", "protocol": "6::BIGINT",
    "port": _big(_swap("port_a")), "ipv4": _little_endian("ip_a"), "remote_ip": _little_endian("ip_b"),
}
BLOCKED_V2 = {
    **base_sql("'netconnblocked'", "blocked_netconn"), "protocol": "6::BIGINT", "domain": "text",
    "direction": "CASE WHEN small > 9 THEN 'outbound' ELSE 'inbound' END", "local_ip": _little_endian("ip_a"),
    "local_port": _big(_swap("port_b")), "remote_ip": _ipv6_sql(), "remote_port": _big(_swap("port_a")), "proxy": "even",
    "proxy_ip": f"CASE WHEN even THEN {_little_endian('ip_b')} ELSE '' END",
    "proxy_port": _big(f"CASE WHEN even THEN {_swap('port_b')} ELSE 0 END"),
    "proxy_domain": "CASE WHEN even THEN text ELSE '' END",
}


@query("build_netconn_blocked_v1", _select(BLOCKED_V1, "fam = 13"), ("sensor_flat",))
def build_netconn_blocked_v1(t: Tables):
    values = sensor.build_netconn_blocked(OPTIONS, 1)
    rows = events_with_env(t).filter("netconnBlocked is not null")
    return plain(rows.select("event_id", *[c.alias(k) for k, c in values.items()]))


@query("build_netconn_blocked_v2", _select(BLOCKED_V2, "fam = 14"), ("sensor_flat",))
def build_netconn_blocked_v2(t: Tables):
    values = sensor.build_netconn_blocked(OPTIONS, 2)
    rows = events_with_env(t).filter("netconnBlockedv2 is not null")
    return plain(rows.select("event_id", *[c.alias(k) for k, c in values.items()]))


# ---- older naming ----------------------------------------------------------------------------------------------------

LEGACY_MESSAGE = {**MESSAGE_SQL, "fork_pid": _big("h_fork"), "pid": _big("coalesce(h_pid, 0)")}
FULL_HASH = {"sha256": f"coalesce({HEAD_SHA}, '')", "md5": f"coalesce({HEAD_MD5}, '')"}


def legacy_sql(family: str) -> dict[str, str]:
    columns = {k: v for k, v in FAMILY_SQL[family].items() if k != "cb_server"}
    if family not in sensor.WITHOUT_PROCESS:
        columns |= LEGACY_MESSAGE
    if family in ("filemod", "netconn_v2", "netconn_v1", "regmod", "crossproc", "emet", "script"):
        columns |= FULL_HASH
    if family == "process":
        columns["md5"] = f"CASE WHEN fam = 0 THEN coalesce({OWN_MD5}, {HEAD_MD5}, '') ELSE coalesce({HEAD_MD5}, '') END"
        columns["sha256"] = f"CASE WHEN fam = 0 THEN coalesce({OWN_SHA}, {HEAD_SHA}, '') ELSE coalesce({HEAD_SHA}, '') END"
        columns["parent_process_guid"] = PARENT_GUID
    elif family == "modload":
        columns |= {"md5": f"coalesce({OWN_MD5}, '')", "sha256": f"coalesce({OWN_SHA}, '')"}
        columns.pop("command_line")
    elif family == "childproc":
        columns |= {"md5": f"coalesce({OWN_MD5}, '')", "sha256": f"coalesce({OWN_SHA}, '')", "child_process_guid": CHILD_GUID,
                    "childproc_username": "CASE WHEN small > 9 THEN coalesce(h_path, '') END"}
    elif family == "netconn_v2":
        columns["proxy_port"] = _big(f"CASE WHEN small > 13 THEN {_swap('port_b')} END")
        columns["proxy_ip"] = f"CASE WHEN small > 13 THEN {_little_endian('ip_b')} END"
        columns["proxy_domain"] = "CASE WHEN small > 13 THEN text END"
    elif family == "netconn_v1":
        columns["remote_port"] = _big(f"CASE WHEN has_own THEN {_swap('port_a')} END")
        columns["local_port"] = _big(f"CASE WHEN NOT has_own THEN {_swap('port_b')} END")
    elif family == "crossproc":
        columns["requested_access"] = _big("CASE WHEN user_id % 2 = 0 THEN small * 100 END")
    elif family == "script":
        columns["event_type"] = "'FilelessScriptload'"
    elif family == "blocked":
        columns["type"] = "'ingress.event.processblock'"
        columns["pid"] = _big(f"CASE WHEN {HAS_BLOCKED_PID} THEN h_pid END")
        columns["username"] = "CASE WHEN small % 3 = 0 AND small % 8 = 0 THEN coalesce(h_path, '') END"
        columns["blocked_error"] = _big("CASE WHEN small % 8 IN (5, 6) THEN user_id END")
    renames = sensor.LEGACY_RENAMES.get(family, {})
    return {renames.get(k, k): v for k, v in columns.items()}


def _legacy_query(family: str) -> None:
    @query(f"legacy_{family}", _select(legacy_sql(family), FAM[family]), ("sensor_flat",))
    def run(t: Tables):
        return plain(sensor.build(events_with_env(t), family, OPTIONS, naming="legacy", keep=("event_id",)))


for _family in sensor.FAMILIES:
    _legacy_query(_family)


# ---- the whole path --------------------------------------------------------------------------------------------------

WIDE = (
    "timestamp", "type", "sensor_id", "computer_name", "event_type", "process_guid", "pid", "path", "md5", "sha256",
    "parent_guid", "action", "domain", "direction", "remote_ip", "local_port", "link_target", "blocked_result",
    "tamper_type", "mitigation", "script", "childproc_type", "size",
)


def wide_sql() -> str:
    parts = []
    for family, columns in FAMILY_SQL.items():
        chosen = {k: f"cast({columns[k]} AS VARCHAR)" if k in columns else "NULL::VARCHAR" for k in WIDE}
        parts.append(_select(chosen, FAM[family], f"event_id, '{family}' AS family"))
    return "\nUNION ALL ".join(parts)


@query("normalize_sensor", wide_sql(), ("sensor_flat",))
def normalize_sensor(t: Tables):
    """Events of all families as JSON in one pass; some keys read back out of the text."""
    rows = sensor.normalize_sensor(t.sensor_events(), ALL_TYPES, OPTIONS, keep=("event_id",))
    e = F.from_json("value", "map<string,string>")
    return rows.select("event_id", "family", e.alias("e")).select("event_id", "family", *[F.col("e")[k].alias(k) for k in WIDE])


@query("normalize_sensor_wide", wide_sql(), ("sensor_flat",))
def normalize_sensor_wide(t: Tables):
    """The same as one wide typed table."""
    rows = sensor.normalize_sensor(t.sensor_events(), ALL_TYPES, OPTIONS, form="columns", keep=("event_id",))
    return rows.select("event_id", "family", *[F.col(k).cast("string").alias(k) for k in WIDE])


@query("decode_frames", wide_sql(), ("sensor_flat",))
def decode_frames(t: Tables):
    """Messages encoded to frames, framed into one run per message, split, decoded and normalized again."""
    encoded = frames.encode_frames(t.sensor_events().select("event_id", "headers", *sensor_parts(t)))
    bodies = encoded.withColumn("body", frame_bytes(F.col("frame"))).drop("frame")
    decoded = frames.decode_frames(frames.split_frames(bodies))
    rows = sensor.normalize_sensor(decoded, ALL_TYPES, OPTIONS, keep=("event_id",))
    e = F.from_json("value", "map<string,string>")
    return rows.select("event_id", "family", e.alias("e")).select("event_id", "family", *[F.col("e")[k].alias(k) for k in WIDE])


def sensor_parts(t: Tables) -> list[str]:
    from ..sources.sensor_schema import spark_type

    return spark_type().names


def frame_bytes(frame):
    """A frame with its length in front, as bundles hold it."""
    n = F.octet_length(frame)
    octets = [F.lpad(F.hex(F.shiftright(n, s).bitwiseAND(255)), 2, "0") for s in (0, 8, 16, 24)]
    return F.concat(F.unhex(F.concat(*octets)), frame)


@query(
    "sensor_leef",
    """SELECT event_id, CASE WHEN fam = 0 THEN 'ingress.event.process' WHEN fam = 15 THEN 'ingress.event.procend'
              ELSE 'ingress.event.netconn' END AS header_type,
              CASE WHEN fam IN (3, 4) THEN CASE WHEN dir = 'inbound' THEN r ELSE l END END AS src,
              CASE WHEN fam IN (3, 4) THEN CASE WHEN dir = 'inbound' THEN l ELSE r END END AS dst
       FROM (SELECT event_id, fam, CASE WHEN fam = 3 THEN d3 WHEN fam = 4 THEN d4 END AS dir,
                    CASE WHEN fam = 3 THEN l3 ELSE l4 END AS l, CASE WHEN fam = 3 THEN r3 ELSE r4 END AS r
             FROM (SELECT event_id, fam, """
    + ", ".join(
        f"{FAMILY_SQL[f][c]} AS {a}"
        for f, n in (("netconn_v2", 3), ("netconn_v1", 4))
        for c, a in (("direction", f"d{n}"), ("local_ip", f"l{n}"), ("remote_ip", f"r{n}"))
    )
    + " FROM sensor_flat WHERE fam IN (0, 3, 4, 15)))",
    ("sensor_flat",),
)
def sensor_leef(t: Tables):
    """Sensor events as LEEF: their JSON text is read back as a message and encoded like a hit."""
    from ..functions.variants import MESSAGE
    from ..operators.encode import encode_leef

    types = [sensor.PREFIX + k for k in ("process", "netconn")]
    rows = sensor.normalize_sensor(t.sensor_events(), types, OPTIONS, keep=("event_id",))
    lines = encode_leef(rows.select("event_id", F.from_json("value", MESSAGE).alias("msg")))
    pick = lambda k: F.nullif(F.regexp_extract("value", rf"[\t|]{k}=([^\t]*)", 1), F.lit(""))
    return lines.select("event_id", F.split("value", r"\|")[4].alias("header_type"), pick("src").alias("src"), pick("dst").alias("dst"))


# ---- lookups ---------------------------------------------------------------------------------------------------------


@query("lookup_string", f"SELECT event_id, {PATH} AS path FROM sensor_flat", ("sensor_flat",))
def lookup_string(t: Tables):
    """Path from the message's own string table."""
    return t.sensor_events().select("event_id", sensor.lookup_string().alias("path"))


@query(
    "lookup_string_table",
    """SELECT event_id, coalesce(p_name, '') AS path FROM sensor_flat LEFT JOIN part ON p_partkey = h_path_guid""",
    ("sensor_flat",),
)
def lookup_string_table(t: Tables):
    """Path from a side table in which later entries of an id must lose."""
    found = joins.lookup_string(t.view("sensor_flat"), t.view("string_table"), "h_path_guid", out="found")
    return found.select("event_id", F.col("found").alias("path"))
