"""Endpoint-sensor events: nested message -> flat event record.

The input is a DataFrame with one column per part of the message (``sources.sensor_schema``). Each ``build_*``
function returns the output columns of one family as a dict in output order, holding plain values: absent optional
input already reads as its default. Which columns disappear when zero or empty is stated once per family in
``OMITTED``. Everything is a narrow projection; the families share one pass over the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# ---- fixed values: event types, enum texts, omission rules -----------------------------------------------------------

PREFIX = "ingress.event."

# family: (sub-message, event_type, enabled by any of these types), in dispatch order
FAMILIES = {
    "process": ("process", "proc", ("process", "procstart", "procend")),
    "modload": ("modload", "modload", ("moduleload",)),
    "filemod": ("filemod", "filemod", ("filemod",)),
    "netconn_v2": ("networkv2", "netconn", ("netconn",)),
    "netconn_v1": ("network", "netconn", ("netconn",)),
    "regmod": ("regmod", "regmod", ("regmod",)),
    "childproc": ("childproc", "childproc", ("childproc",)),
    "crossproc": ("crossproc", "cross_process", ("crossprocopen",)),
    "emet": ("emet", "emet_mitigation", ("emetmitigation",)),
    "script": ("scriptexe", "filelessscriptload", ("filelessscriptload",)),
    "tamper": ("tamperAlert", "tamper", ("tamper",)),
    "blocked": ("blocked", "blocked_process", ("processblock",)),
    "module": ("module", "binary_info", ("module",)),
}
# Messages carrying one of these are dropped even when a later family is present too.
NEVER_ENABLED_BEFORE = ("tamper", ("netconnBlockedv2", "netconnBlocked"))

REGMOD_ACTIONS = {1: "createkey", 2: "writeval", 4: "delkey", 8: "delval"}
FILEMOD_ACTIONS = {1: "create", 2: "write", 4: "delete", 8: "lastwrite"}
FILE_TYPES = {
    0x00: "Unknown", 0x01: "Pe", 0x02: "Elf", 0x03: "UniversalBin", 0x08: "Eicar", 0x10: "OfficeLegacy",
    0x11: "OfficeOpenXml", 0x30: "Pdf", 0x40: "ArchivePkzip", 0x41: "ArchiveLzh", 0x42: "ArchiveLzw",
    0x43: "ArchiveRar", 0x44: "ArchiveTar", 0x45: "Archive7zip", 0x60: "MsLnk", 0x70: "FlashFlv", 0x71: "FlashSwf",
}
CHILD_TYPES = {0: "Exec", 1: "Fork", 2: "OtherExec"}
OPEN_TYPES = {1: "open_process", 2: "open_thread"}
TAMPER_TYPES = {
    1: "CoreDriverUnloaded", 2: "NetworkDriverUnloaded", 3: "CbServiceStopped", 4: "CbProcessTerminated",
    5: "CbCodeInjection",
}
BLOCK_EVENTS = {1: "ProcessCreate", 2: "RunningProcess"}
BLOCK_RESULTS = {
    0: "ProcessTerminated", 1: "NotTerminatedCBProcess", 2: "NotTerminatedSystemProcess",
    3: "NotTerminatedCriticalSystemProcess", 4: "NotTerminatedWhitelistPath", 5: "NotTerminatedOpenProcessError",
    6: "NotTerminatedTerminateError",
}
# Names of the mitigation types, from 1 on.
MITIGATIONS = {
    1: "Dep", 2: "Sehop", 3: "Asr", 4: "Aslr", 5: "NullPage", 6: "HeapSpray", 7: "MandatoryAslr", 8: "Eaf",
    9: "EafPlus", 10: "BottomUpAslr", 11: "LoadLibrary", 12: "MemoryProtection", 13: "SimulateExecFlow",
    14: "StackPivot", 15: "CallerChecks", 16: "BannedFunctions", 17: "DeepHooks", 18: "AntiDetours",
}
TCP = 6

# Fields that are left out of an event while they are empty.
MESSAGE_FIELDS = ("fork_pid", "pid", "process_guid", "link_process", "link_sensor", "process_path")
HASH_FIELDS = ("sha256", "md5")
OMITTED = {
    "process": (*MESSAGE_FIELDS, "parent_md5", "parent_sha256", "link_parent", "username", "uid"),
    "modload": (*MESSAGE_FIELDS,),
    "filemod": (*MESSAGE_FIELDS, *HASH_FIELDS, "file_sha256", "file_md5", "filetype_name"),
    "netconn_v2": (*MESSAGE_FIELDS, *HASH_FIELDS, "ja3", "ja3s", "proxy_port"),
    "netconn_v1": (*MESSAGE_FIELDS, *HASH_FIELDS, "remote_port", "local_ip", "local_port", "remote_ip"),
    "regmod": (*MESSAGE_FIELDS, *HASH_FIELDS),
    "childproc": (*MESSAGE_FIELDS, "parent_guid", "link_child", "childproc_commandline", "childproc_username"),
    "crossproc": (*MESSAGE_FIELDS, *HASH_FIELDS, "requested_access", "link_target"),
    "emet": (*MESSAGE_FIELDS, *HASH_FIELDS),
    "script": (*MESSAGE_FIELDS, *HASH_FIELDS),
    "tamper": (),
    "blocked": (
        "link_target", "process_guid", "process_create_time", "command_line", "pid", "uid", "username",
        "blocked_error", "blocked_event", "blocked_reason", "blocked_result",
    ),
    "module": (),
}
NUMERIC_OMITTED = {
    "fork_pid", "pid", "remote_port", "local_port", "proxy_port", "requested_access", "process_create_time",
    "blocked_error",
}

Values = dict[str, Column]


@dataclass(frozen=True)
class Options:
    """Settings every builder sees: server name, base url of links ('' for none), fractional timestamps.

    ``prepared`` says that the columns all families share are already in the DataFrame (``prepare``).
    """

    server: str = ""
    url: str = ""
    float_time: bool = False
    prepared: bool = False

    def shared(self, name: str, make: Callable[[], Column]) -> Column:
        return F.col(f"_{name}") if self.prepared else make()

    def time(self, ticks: Column) -> Column:
        return S.unix_seconds_float(ticks) if self.float_time else S.unix_seconds(ticks)

    def link(self, *parts: Column | str) -> Column:
        if not self.url:
            return F.lit("")
        base = self.url if self.url.endswith("/") else self.url + "/"
        return F.concat(F.lit(base), *[F.lit(p) if isinstance(p, str) else p for p in parts])


# ---- shared columns --------------------------------------------------------------------------------------------------


def header(name: str) -> Column:
    return F.col("header")[name]


def sensor() -> Column:
    return F.col("env")["endpoint"]["SensorId"]


def sensor_or_zero() -> Column:
    return F.coalesce(sensor(), F.lit(0))


def number(c: Column, kind: str = "int") -> Column:
    return F.coalesce(c, F.lit(0).cast(kind))


def decimal_text(c: Column) -> Column:
    return number(c, "bigint").cast("string")


def enum_text(value: Column, names: dict[int, str], unknown: str | None = "unknown (%d)") -> Column:
    """Name of an enum value; other values print through ``unknown`` ('' when it is None)."""
    text = None
    for n, name in names.items():
        text = F.when(value == n, name) if text is None else text.when(value == n, name)
    return text.otherwise(F.format_string(unknown, value) if unknown else F.lit(""))


def lookup_string() -> Column:
    """Text whose id equals the header's path id in the message's own string table: first match, '' if none."""
    wanted = number(header("filepath_string_guid"), "bigint")
    match = F.filter(F.col("strings"), lambda s: number(s["guid"], "bigint") == wanted)
    return S.utf8_text(F.get(match, F.lit(0))["utf8string"])


def process_guid() -> Column:
    known = header("process_pid").isNotNull() & header("process_create_time").isNotNull() & sensor().isNotNull()
    return F.when(
        known, S.make_guid(sensor(), header("process_pid"), header("process_create_time"))
    ).otherwise(decimal_text(header("process_guid")))


def shared_columns(o: Options) -> Values:
    """Values that most families use; computed once per event."""
    guid = process_guid()
    return {
        "timestamp": o.time(header("timestamp")),
        "sensor_id": sensor_or_zero(),
        "computer_name": S.or_empty(F.col("env")["endpoint"]["SensorHostName"]),
        "fork_pid": number(header("fork_pid")),
        "pid": number(header("process_pid")),
        "process_guid": guid,
        "link_sensor": o.link("#/host/", sensor_or_zero().cast("string")),
        "process_path": S.or_empty(header("process_path")),
        "sha256": S.hex_digest(header("process_sha256")),
        "md5": S.hex_digest(header("process_md5")),
        "path": lookup_string(),
    }


def prepare(df: DataFrame, o: Options) -> tuple[DataFrame, Options]:
    """Put the shared values into columns of their own, so that no family computes them again."""
    return df.withColumns({f"_{k}": c for k, c in shared_columns(o).items()}), replace(o, prepared=True)


def base_columns(o: Options, kind: Column | str, event_type: str) -> Values:
    v = shared_columns(o) if not o.prepared else {}
    take = lambda name: o.shared(name, lambda: v[name])
    return {
        "timestamp": take("timestamp"),
        "cb_server": F.nullif(F.lit(o.server), F.lit("")),
        "type": F.lit(PREFIX + kind) if isinstance(kind, str) else F.concat(F.lit(PREFIX), kind),
        "sensor_id": take("sensor_id"),
        "computer_name": take("computer_name"),
        "event_type": F.lit(event_type),
    }


def event_message_columns(o: Options) -> Values:
    v = shared_columns(o) if not o.prepared else {}
    take = lambda name: o.shared(name, lambda: v[name])
    return {
        "fork_pid": take("fork_pid"),
        "pid": take("pid"),
        "process_guid": take("process_guid"),
        "link_process": o.link("#analyze/", take("process_guid"), "/0"),
        "link_sensor": take("link_sensor"),
        "process_path": take("process_path"),
    }


def header_hash_columns(o: Options | None = None) -> Values:
    o = o or Options()
    return {
        name: o.shared(name, lambda name=name: S.hex_digest(header(f"process_{name}"))) for name in ("sha256", "md5")
    }


def hash_or_header(own: Column, name: str, o: Options | None = None) -> Column:
    """Own hash as hex when it is not empty, else the header's."""
    return F.when(F.octet_length(own) > 0, F.hex(own)).otherwise(header_hash_columns(o)[name])


def _direction(outbound: Column) -> Column:
    return F.when(F.coalesce(outbound, F.lit(True)), "outbound").otherwise("inbound")


# ---- one builder per family ------------------------------------------------------------------------------------------


def build_process(o: Options) -> Values:
    p = F.col("process")
    created = S.or_false(p["created"])
    own = lambda f, h: F.when(created, S.hex_digest(F.coalesce(p[f], header(h)))).otherwise("")
    return {
        **base_columns(o, F.when(created, "procstart").otherwise("procend"), "proc"),
        **event_message_columns(o),
        "path": o.shared("path", lookup_string),
        "md5": own("md5hash", "process_md5"),
        "sha256": own("sha256hash", "process_sha256"),
        "command_line": S.utf8_text(p["commandline"]),
        "parent_path": S.or_empty(p["parent_path"]),
        "parent_pid": number(p["parent_pid"]),
        "parent_guid": number(p["parent_guid"], "bigint"),
        "parent_create_time": o.time(p["parent_create_time"]),
        "filtering_known_dlls": S.or_false(p["bFilteringKnownDlls"]),
        "parent_md5": S.hex_digest(p["parent_md5"]),
        "parent_sha256": S.hex_digest(p["parent_sha256"]),
        "expect_followon_w_md5": S.or_false(p["expect_followon_w_md5"]),
        "link_parent": o.link("#analyze/", parent_process_guid(), "/1"),
        "username": S.or_empty(p["username"]),
        "uid": S.or_empty(p["uid"]),
    }


def parent_process_guid() -> Column:
    p = F.col("process")
    known = sensor().isNotNull() & p["parent_pid"].isNotNull() & p["parent_create_time"].isNotNull()
    return F.when(known, S.make_guid(sensor(), p["parent_pid"], p["parent_create_time"])).otherwise(
        decimal_text(p["parent_guid"])
    )


def build_modload(o: Options) -> Values:
    return {
        **base_columns(o, "moduleload", "modload"),
        **event_message_columns(o),
        "path": o.shared("path", lookup_string),
        "md5": hash_or_header(F.col("modload")["md5hash"], "md5", o),
        "sha256": hash_or_header(F.col("modload")["sha256hash"], "sha256", o),
        "command_line": F.lit(""),
    }


def build_filemod(o: Options) -> Values:
    f = F.col("filemod")
    action = F.coalesce(f["action"], F.lit(1))
    return {
        **base_columns(o, "filemod", "filemod"),
        **event_message_columns(o),
        **header_hash_columns(o),
        "path": o.shared("path", lookup_string),
        "tamper_sent": S.or_false(f["tamper_sent"]),
        "tamper": S.or_false(f["tamper"]),
        "file_sha256": S.hex_digest(f["sha256hash"]),
        "file_md5": S.hex_digest(f["md5hash"]),
        "filetype_name": enum_text(number(f["type"]), FILE_TYPES, unknown=None),
        "action_type": action,
        "action": enum_text(action, FILEMOD_ACTIONS),
        "file_type": number(f["type"]),
    }


def _netconn_v2_columns(n: Column) -> Values:
    proxied = S.or_false(n["proxyConnection"])
    return {
        "protocol": F.coalesce(n["protocol"], F.lit(TCP)),
        "domain": S.utf8_text(n["utf8_netpath"]),
        "direction": _direction(n["outbound"]),
        "local_ip": S.ip_address(n["localIpAddress"]),
        "local_port": S.ntohs(number(n["localPort"], "bigint")).cast("int"),
        "remote_ip": S.ip_address(n["remoteIpAddress"]),
        "remote_port": S.ntohs(number(n["remotePort"], "bigint")).cast("int"),
        "proxy": proxied,
        "proxy_ip": F.when(proxied, S.ip_address(n["proxyIpAddress"])).otherwise(""),
        "proxy_port": F.when(proxied, S.ntohs(number(n["proxyPort"], "bigint"))).otherwise(0).cast("int"),
        "proxy_domain": F.when(proxied, S.or_empty(n["proxyNetPath"])).otherwise(""),
    }


def build_netconn_v2(o: Options) -> Values:
    n = F.col("networkv2")
    return {
        **base_columns(o, "netconn", "netconn"),
        **event_message_columns(o),
        **header_hash_columns(o),
        **_netconn_v2_columns(n),
        "ja3": S.or_empty(n["ja3"]),
        "ja3s": S.or_empty(n["ja3s"]),
    }


def _netconn_v1_columns(n: Column) -> Values:
    port = lambda known, p: F.when(known.isNotNull(), S.ntohs(number(p, "bigint"))).otherwise(0).cast("int")
    return {
        "remote_port": port(n["remoteIpAddress"], n["remotePort"]),
        "local_ip": S.or_empty(S.ipv4_little_endian(n["localIpAddress"])),
        "local_port": port(n["localIpAddress"], n["localPort"]),
        "direction": _direction(n["outbound"]),
        "domain": S.utf8_text(n["utf8_netpath"]),
        "protocol": F.coalesce(n["protocol"], F.lit(TCP)),
        "port": S.ntohs(number(n["port"], "bigint")).cast("int"),
        "ipv4": S.ipv4_little_endian(number(n["ipv4Address"], "bigint")),
        "remote_ip": S.or_empty(S.ipv4_little_endian(n["remoteIpAddress"])),
    }


def build_netconn_v1(o: Options) -> Values:
    return {
        **base_columns(o, "netconn", "netconn"),
        **event_message_columns(o),
        **header_hash_columns(o),
        **_netconn_v1_columns(F.col("network")),
    }


def build_regmod(o: Options) -> Values:
    r = F.col("regmod")
    action = F.coalesce(r["action"], F.lit(1))
    return {
        **base_columns(o, "regmod", "regmod"),
        **event_message_columns(o),
        **header_hash_columns(o),
        "path": S.utf8_text(r["utf8_regpath"]),
        "action": enum_text(action, REGMOD_ACTIONS),
        "action_type": action,
        "tamper_sent": S.or_false(r["tamper_sent"]),
        "tamper": S.or_false(r["tamper"]),
    }


def child_process_guid() -> Column:
    c = F.col("childproc")
    known = c["pid"].isNotNull() & c["create_time"].isNotNull() & sensor().isNotNull()
    return F.when(known, S.make_guid(sensor(), c["pid"], c["create_time"])).otherwise(decimal_text(c["child_guid"]))


def build_childproc(o: Options) -> Values:
    c = F.col("childproc")
    suppressed = S.or_false(c["suppressed"]["bIsSuppressed"])
    header_known = header("process_create_time").isNotNull() & header("process_pid").isNotNull()
    return {
        **base_columns(o, "childproc", "childproc"),
        **event_message_columns(o),
        "parent_guid": F.when(
            header_known, S.make_guid(sensor_or_zero(), header("process_pid"), header("process_create_time"))
        ).otherwise(decimal_text(c["parent_guid"])),
        "link_child": o.link("#analyze/", child_process_guid(), "/1"),
        "created": S.or_false(c["created"]),
        "tamper_sent": S.or_false(c["tamper_sent"]),
        "tamper": S.or_false(c["tamper"]),
        "path": S.or_empty(c["path"]),
        "md5": hash_or_header(c["md5hash"], "md5", o),
        "sha256": hash_or_header(c["sha256hash"], "sha256", o),
        "childproc_type": enum_text(number(c["childProcType"]), CHILD_TYPES, unknown=None),
        "childproc_suppressed": suppressed,
        "childproc_commandline": F.when(suppressed, S.utf8_text(c["commandline"])).otherwise(""),
        "childproc_username": F.when(suppressed, S.or_empty(c["username"])).otherwise(""),
        "child_pid": number(c["pid"], "bigint"),
    }


def build_crossproc(o: Options) -> Values:
    opened, thread = F.col("crossproc")["open"], F.col("crossproc")["remotethread"]
    is_open = opened.isNotNull()
    either = lambda a, b: F.when(is_open, opened[a]).otherwise(thread[b])
    pid = number(either("targetPid", "remoteProcPid"), "bigint")
    created = number(either("targetProcCreateTime", "remoteProcCreateTime"), "decimal(20,0)")
    guid = S.make_guid(sensor_or_zero(), pid, S.unsigned_bits(created))
    return {
        **base_columns(o, F.when(is_open, "crossprocopen").otherwise("remotethread"), "cross_process"),
        **event_message_columns(o),
        **header_hash_columns(o),
        "is_target": S.or_false(F.col("crossproc")["isTarget"]),
        "cross_process_type": F.when(
            is_open, enum_text(F.coalesce(opened["type"], F.lit(1)), OPEN_TYPES)
        ).otherwise("remote_thread"),
        "target_md5": S.hex_digest(either("targetProcMd5", "remoteProcMd5")),
        "requested_access": F.when(is_open, number(opened["requestedAccess"], "bigint")).otherwise(0),
        "link_target": o.link("#analyze/", guid, "/1"),
        "target_path": S.or_empty(either("targetProcPath", "remoteProcPath")),
        "target_sha256": S.hex_digest(either("targetProcSha256", "remoteProcSha256")),
        "target_pid": pid,
        "target_create_time": created,
        "target_process_guid": guid,
    }


def build_emet(o: Options) -> Values:
    e = F.col("emet")
    return {
        **base_columns(o, "emetmitigation", "emet_mitigation"),
        **event_message_columns(o),
        **header_hash_columns(o),
        "log_message": S.or_empty(e["actionText"]),
        "mitigation": enum_text(F.coalesce(e["action"]["mitigationType"], F.lit(1)), MITIGATIONS),
        "blocked": S.or_false(e["blocked"]),
        "emet_timestamp": number(e["emetTimstamp"], "decimal(20,0)"),
        "log_id": number(e["emetId"], "decimal(20,0)"),
    }


def build_script(o: Options) -> Values:
    return {
        **base_columns(o, "filelessscriptload", "filelessscriptload"),
        **event_message_columns(o),
        **header_hash_columns(o),
        "script_sha256": S.or_empty(F.col("scriptexe")["sha256"]),
        "script": S.or_empty(F.col("scriptexe")["script"]),
    }


def build_tamper(o: Options) -> Values:
    kind = F.coalesce(F.col("tamperAlert")["type"], F.lit(1))
    return {**base_columns(o, "tamper", "tamper"), "tamper_type": enum_text(kind, TAMPER_TYPES)}


def build_blocked(o: Options) -> Values:
    b = F.col("blocked")
    reason = F.coalesce(b["blockedType"], F.lit(1))
    event = F.coalesce(b["blockedEvent"], F.lit(1))
    result = number(b["blockResult"])
    has_pid = b["blockedPid"].isNotNull()
    guid = S.make_guid(sensor_or_zero(), b["blockedPid"], S.unsigned_bits(b["blockedProcCreateTime"]))
    kept_from_starting = (event == 1) & (result == 0)
    when_kept = lambda f: F.when(kept_from_starting, S.or_empty(b[f])).otherwise("")
    return {
        **base_columns(o, "processblocked", "blocked_process"),
        "md5": S.hex_digest(b["blockedmd5Hash"]),
        "path": S.or_empty(b["blockedPath"]),
        "link_target": F.when(has_pid, o.link("#analyze/", guid, "/1")).otherwise(""),
        "process_guid": F.when(has_pid, guid).otherwise(""),
        "process_create_time": F.when(has_pid, number(b["blockedProcCreateTime"], "decimal(20,0)")).otherwise(
            F.lit(0).cast("decimal(20,0)")
        ),
        "command_line": S.or_empty(b["blockedCmdline"]),
        "pid": number(b["blockedPid"]),
        "uid": when_kept("blockedUid"),
        "username": when_kept("blockedUsername"),
        "blocked_error": F.when(result.isin(5, 6), number(b["blockError"], "bigint")).otherwise(0),
        "blocked_event": enum_text(event, BLOCK_EVENTS),
        "blocked_reason": enum_text(reason, {1: "Md5Hash"}),
        "blocked_result": enum_text(result, BLOCK_RESULTS),
    }


# output key: input field, in output order
MODULE_TEXTS = {
    "utf_8_file_description": "utf8_FileDescription",
    "utf_8_company_name": "utf8_CompanyName",
    "utf_8_comments": "utf8_Comments",
    "utf_8_file_version": "utf8_FileVersion",
    "utf_8_legal_copyright": "utf8_LegalCopyright",
    "utf_8_legal_trademark": "utf8_LegalTrademark",
    "utf_8_internal_name": "utf8_InternalName",
    "utf_8_product_name": "utf8_ProductName",
    "utf_8_original_file_name": "utf8_OriginalFileName",
    "utf_8_product_description": "utf8_ProductDescription",
    "utf_8_product_version": "utf8_ProductVersion",
    "utf_8_special_build": "utf8_SpecialBuild",
    "utf_8_on_disk_filename": "utf8_OnDiskFilename",
    "utf_8_private_build": "utf8_PrivateBuild",
}
DIGSIG_TEXTS = {
    "result": "Result",
    "publisher": "Publisher",
    "program_name": "ProgramName",
    "issuer_name": "IssuerName",
    "result_code": "ResultCode",
    "subject_name": "SubjectName",
    "sign_time": "SignTime",
}


def build_module(o: Options) -> Values:
    m = F.col("module")
    empty = F.lit(b"")
    return {
        **base_columns(o, "module", "binary_info"),
        "digsig": F.struct(*[S.or_empty(m[f"utf8_DigSig_{f}"]).alias(k) for k, f in DIGSIG_TEXTS.items()]),
        "utf_8_copied_module_length": number(m["CopiedModuleLength"], "bigint"),
        **{k: S.or_empty(m[f]) for k, f in MODULE_TEXTS.items()},
        "image_file_header": F.coalesce(m["ImageFileHeader"], empty),
        "icon": F.coalesce(m["Icon"], empty),
        "size": number(m["OriginalModuleLength"], "decimal(20,0)"),
        "sha256": S.upper(S.utf8_text(m["sha256"])),
        "md5": S.upper(S.utf8_text(m["md5"])),
    }


def build_netconn_blocked(o: Options, version: int = 2) -> Values:
    """Columns of a blocked connection; not part of ``normalize_sensor``, which drops these messages."""
    common = {**base_columns(o, "netconnblocked", "blocked_netconn")}
    if version == 1:
        return {**common, **_netconn_v1_columns(F.col("netconnBlocked"))}
    return {**common, **_netconn_v2_columns(F.col("netconnBlockedv2"))}


BUILDERS: dict[str, Callable[[Options], Values]] = {
    "process": build_process,
    "modload": build_modload,
    "filemod": build_filemod,
    "netconn_v2": build_netconn_v2,
    "netconn_v1": build_netconn_v1,
    "regmod": build_regmod,
    "childproc": build_childproc,
    "crossproc": build_crossproc,
    "emet": build_emet,
    "script": build_script,
    "tamper": build_tamper,
    "blocked": build_blocked,
    "module": build_module,
}


NEVER_EMPTY = ("process_guid", "link_process", "link_sensor")


def omit_empty(family: str, values: Values, o: Options) -> Values:
    """Turn zero or empty values into NULL where the family leaves the key out."""
    out = {}
    for k, c in values.items():
        if k not in OMITTED[family] or (k in NEVER_EMPTY and o.url and family != "blocked"):
            out[k] = c
        else:
            out[k] = F.when(c != (F.lit(0) if k in NUMERIC_OMITTED else F.lit("")), c)
    return out


# ---- older naming ----------------------------------------------------------------------------------------------------

LEGACY_RENAMES = {
    "filemod": {"action_type": "actiontype", "file_type": "filetype"},
    "regmod": {"action_type": "actiontype"},
    "childproc": {
        "childproc_suppressed": "child_suppressed",
        "childproc_commandline": "child_command_line",
        "childproc_username": "child_username",
    },
    "module": {
        k: k.replace("utf_8_", "utf8_") for k in (*MODULE_TEXTS, "utf_8_copied_module_length")
    },
}
WITHOUT_PROCESS = ("tamper", "blocked", "module")


def legacy_naming(family: str, o: Options) -> Values:
    """Output columns under the older naming.

    Process details are added to every family that describes a process, and the header's hashes only where the family
    sets none itself. Keys are left out by presence of the input rather than by emptiness.
    """
    v = dict(BUILDERS[family](o))
    v.pop("cb_server")
    unless_empty = lambda c: F.when(c != "", c)
    for link in ("link_process", "link_sensor", "link_parent", "link_child", "link_target"):
        if link in v:
            v[link] = unless_empty(v[link])
    if family not in WITHOUT_PROCESS:
        v["fork_pid"] = header("fork_pid")
        v["process_path"] = unless_empty(v["process_path"])
    hashes = header_hash_columns(o)
    if family == "process":
        p = F.col("process")
        own = lambda f: F.when(S.or_false(p["created"]), F.hex(p[f]))
        v["md5"] = F.coalesce(own("md5hash"), hashes["md5"])
        v["sha256"] = F.coalesce(own("sha256hash"), hashes["sha256"])
        v["parent_md5"], v["parent_sha256"] = F.hex(p["parent_md5"]), F.hex(p["parent_sha256"])
        v["username"], v["uid"] = p["username"], p["uid"]
        v["parent_process_guid"] = parent_process_guid()
    elif family == "modload":
        v.pop("command_line")
        m = F.col("modload")
        v["md5"], v["sha256"] = S.hex_digest(m["md5hash"]), S.hex_digest(m["sha256hash"])
    elif family == "childproc":
        c = F.col("childproc")
        v["md5"], v["sha256"] = S.hex_digest(c["md5hash"]), S.hex_digest(c["sha256hash"])
        v["child_process_guid"] = child_process_guid()
        for k in ("childproc_commandline", "childproc_username"):
            v[k] = F.when(v["childproc_suppressed"], v[k])
    elif family == "filemod":
        f = F.col("filemod")
        v["file_md5"], v["file_sha256"] = F.hex(f["md5hash"]), F.hex(f["sha256hash"])
    elif family == "netconn_v2":
        n = F.col("networkv2")
        v["ja3"], v["ja3s"] = n["ja3"], n["ja3s"]
        for k in ("proxy_ip", "proxy_port", "proxy_domain"):
            v[k] = F.when(v["proxy"], v[k])
    elif family == "netconn_v1":
        n = F.col("network")
        for side in ("remote", "local"):
            known = n[f"{side}IpAddress"].isNotNull()
            v[f"{side}_ip"], v[f"{side}_port"] = (F.when(known, v[f"{side}_{k}"]) for k in ("ip", "port"))
    elif family == "crossproc":
        v["requested_access"] = F.when(F.col("crossproc")["open"].isNotNull(), v["requested_access"])
    elif family == "script":
        v["event_type"] = F.lit("FilelessScriptload")
    elif family == "blocked":
        b = F.col("blocked")
        v["type"] = F.lit(PREFIX + "processblock")
        v["blocked_error"] = F.when(number(b["blockResult"]).isin(5, 6), v["blocked_error"])
        for k in ("pid", "process_create_time", "process_guid"):
            v[k] = F.when(b["blockedPid"].isNotNull(), v[k])
        kept = (F.coalesce(b["blockedEvent"], F.lit(1)) == 1) & (number(b["blockResult"]) == 0)
        v["uid"], v["username"] = F.when(kept, v["uid"]), F.when(kept, v["username"])
    return {LEGACY_RENAMES.get(family, {}).get(k, k): c for k, c in v.items()}


# ---- dispatch, filters and the whole path ----------------------------------------------------------------------------


def dispatch_family(df: DataFrame, out: str = "family") -> DataFrame:
    """Name of the first sub-message present; NULL for messages that are always dropped or not understood."""
    before, blockers = NEVER_ENABLED_BEFORE
    chain = None
    for family, (part, _, _) in FAMILIES.items():
        if family == before:
            for b in blockers:
                if b in df.columns:
                    chain = chain.when(F.col(b).isNotNull(), F.lit(None).cast("string"))
        present = F.col(part).isNotNull()
        chain = F.when(present, family) if chain is None else chain.when(present, family)
    return df.withColumn(out, chain)


def enabled_families(enabled: list[str], strict_crossproc: bool = False) -> list[str]:
    """Families switched on by a set of event types."""
    keys = set(enabled)
    on = [f for f, (_, _, types) in FAMILIES.items() if keys & {PREFIX + t for t in types}]
    if strict_crossproc and PREFIX + "remotethread" in keys and "crossproc" not in on:
        on.append("crossproc")
    return on


def event_enabled_filter(df: DataFrame, enabled: list[str], strict_procend: bool = False,
                         strict_crossproc: bool = False) -> DataFrame:
    """Keep messages whose family is switched on, before anything is projected.

    By default any of the three process types lets starts and exits through, and open-process subscriptions also
    admit remote threads. ``strict_procend`` drops exits unless they are subscribed themselves;
    ``strict_crossproc`` subscribes the two cross-process kinds one by one.
    """
    if "family" not in df.columns:
        df = dispatch_family(df)
    keep = F.col("family").isin(*enabled_families(enabled, strict_crossproc))
    if strict_procend and PREFIX + "procend" not in enabled:
        keep &= (F.col("family") != "process") | S.or_false(F.col("process")["created"])
    if strict_crossproc:
        is_open = F.col("crossproc")["open"].isNotNull()
        keep &= (
            (F.col("family") != "crossproc")
            | (is_open & F.lit(PREFIX + "crossprocopen" in enabled))
            | (~is_open & F.lit(PREFIX + "remotethread" in enabled))
        )
    return df.filter(keep)


def procend_filter(df: DataFrame, enabled: list[str]) -> DataFrame:
    """Drop process exits unless ``procend`` itself is enabled."""
    if PREFIX + "procend" in enabled:
        return df
    return df.filter(F.col("process").isNull() | S.or_false(F.col("process")["created"]))


ENV_TYPE = "struct<endpoint:struct<SensorId:int,SensorHostName:string,HostId:bigint>,server:struct<NodeId:int>>"


def fill_env(df: DataFrame) -> DataFrame:
    """Take host and sensor from the bus headers where the message has no environment of its own.

    A header number that is present but not an integer makes the row an error, as the headers speak for the bundle.
    """
    h = F.col("headers")
    numbers = {k: S.header_int(h, k) for k in ("hostId", "sensorId", "nodeId")}
    narrow = lambda c: F.shiftright(F.shiftleft(c, 32), 32).cast("int")
    from_headers = F.struct(
        F.struct(
            narrow(numbers["sensorId"]).alias("SensorId"),
            h["sensorHostName"].alias("SensorHostName"),
            numbers["hostId"].alias("HostId"),
        ).alias("endpoint"),
        F.struct(narrow(numbers["nodeId"]).alias("NodeId")).alias("server"),
    ).cast(ENV_TYPE)
    problem = F.lit(None).cast("string")
    for key, value in numbers.items():
        problem = F.when(h[key].isNotNull() & value.isNull(), F.lit(f"bad header {key}")).otherwise(problem)
    previous = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return df.select(
        *[c for c in df.columns if c not in ("env", "error")],
        F.coalesce(F.col("env").cast(ENV_TYPE), from_headers).alias("env"),
        F.coalesce(previous, problem).alias("error"),
    )


def family_columns(family: str, o: Options, naming: str = "current", strict_reference_names: bool = False) -> Values:
    values = legacy_naming(family, o) if naming == "legacy" else omit_empty(family, BUILDERS[family](o), o)
    if strict_reference_names and naming == "current":
        values = {LITERAL_NAMES.get((family, k), k): c for k, c in values.items()}
    return values


# Literal output keys of the current naming where ours differ: a capital letter, a misspelling, two swapped names.
LITERAL_NAMES = {
    ("netconn_v2", "protocol"): "Protocol",
    ("module", "utf_8_file_description"): "utf_8_file_dscription",
    ("regmod", "tamper"): "tamper_sent",
    ("regmod", "tamper_sent"): "tamper",
}


def build(df: DataFrame, family: str, o: Options | None = None, naming: str = "current", keep: tuple[str, ...] = (),
          **literal: bool) -> DataFrame:
    """Typed table of one family."""
    rows = dispatch_family(df, "_family").filter(F.col("_family") == family)
    rows, o = prepare(rows, o or Options())
    values = family_columns(family, o, naming, **literal)
    return rows.select(*keep, *[c.alias(k) for k, c in values.items()])


def normalize_sensor(df: DataFrame, enabled: list[str], o: Options | None = None, naming: str = "current",
                     form: str = "json", keep: tuple[str, ...] = (), strict_procend: bool = False,
                     strict_crossproc: bool = False, **literal: bool) -> DataFrame:
    """Enabled sensor messages as events, in one pass: filter, fill the environment, then one CASE over families.

    ``form='json'`` gives column ``value`` with the event's JSON text; ``form='columns'`` gives one wide row with the
    columns of all families (``parent_guid``, a number for one family and text for another, is text there).
    """
    o = o or Options()
    rows = event_enabled_filter(df, enabled, strict_procend, strict_crossproc)
    rows, o = prepare(fill_env(rows).filter(F.col("error").isNull()), o)
    families = enabled_families(enabled, strict_crossproc)
    columns = {f: family_columns(f, o, naming, **literal) for f in families}
    if form == "json":
        value = None
        for f in families:
            text = F.to_json(F.struct(*[c.alias(k) for k, c in columns[f].items()]))
            value = F.when(F.col("family") == f, text) if value is None else value.when(F.col("family") == f, text)
        return rows.select(*keep, "family", (value if value is not None else F.lit(None).cast("string")).alias("value"))
    wide: dict[str, Column] = {}
    for f, values in columns.items():
        for k, c in values.items():
            c = c.cast("string") if k == "parent_guid" else c
            is_f = F.col("family") == f
            wide[k] = wide[k].when(is_f, c) if k in wide else F.when(is_f, c)
    return rows.select(*keep, "family", *[c.alias(k) for k, c in wide.items()])
