"""Layout of one endpoint-sensor message, as a Spark schema and as a protobuf descriptor.

``WIRE`` holds fixed values: the field numbers, names and types of the binary message. Everything else in this module
is derived from it. Unsigned 64-bit numbers become DECIMAL(20,0) and enums become INT. A sub-message that is present
is a non-NULL struct.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

WIRE = {
    "Header": """1 version i32!, 4 timestamp i64, 5 process_guid i64, 6 filepath_string_guid i64,
        9 process_create_time i64, 10 process_pid i32, 11 process_md5 bytes, 12 process_path str, 13 fork_pid i32,
        14 process_sha256 bytes""",
    "String": "1 guid i64, 2 utf8string bytes, 3 string_type enum",
    "Process": """1 pid i32, 2 created bool, 3 parent_pid i32, 4 parent_create_time i64, 5 parent_guid i64,
        6 md5hash bytes, 9 commandline bytes, 10 parent_md5 bytes, 11 parent_path str, 13 expect_followon_w_md5 bool,
        14 uid str, 15 username str, 18 bFilteringKnownDlls bool, 19 sha256hash bytes, 20 parent_sha256 bytes,
        21 logon_type i32""",
    "Modload": "1 guid i64, 3 md5hash bytes, 8 sha256hash bytes",
    "Filemod": """1 guid i64, 2 action enum, 4 md5hash bytes, 5 type enum, 6 tamper bool, 7 tamper_sent bool,
        8 sha256hash bytes""",
    "Network": """2 ipv4Address u32, 5 port u32, 6 protocol enum, 7 utf8_netpath bytes, 8 outbound bool,
        13 remoteIpAddress u32, 14 remotePort u32, 15 localIpAddress u32, 16 localPort u32""",
    "Regmod": "2 action enum, 4 utf8_regpath bytes, 5 tamper bool, 6 tamper_sent bool",
    "Suppressed": "1 bIsSuppressed bool, 2 state enum",
    "Childproc": """1 created bool, 2 parent_guid i64, 3 md5hash bytes, 4 child_guid i64, 5 path str, 6 pid i64,
        7 create_time i64, 8 tamper bool, 9 suppressed Suppressed, 10 commandline bytes, 11 username str,
        12 childProcType enum, 13 tamper_sent bool, 14 sha256hash bytes""",
    "Ip": "1 bIsIpv6 bool, 2 ipv4Address u32, 3 ipv6Low u64, 4 ipv6High u64, 5 ipv6Scope str",
    "NetworkV2": """1 protocol enum, 2 utf8_netpath bytes, 3 outbound bool, 4 proxyConnection bool,
        5 proxyIpAddress Ip, 6 proxyPort u32, 7 proxyNetPath str, 8 remoteIpAddress Ip, 9 remotePort u32,
        10 localIpAddress Ip, 11 localPort u32, 12 ja3 str, 13 ja3s str""",
    "NetworkBlockedV2": """3 protocol enum, 4 utf8_netpath bytes, 5 outbound bool, 6 proxyConnection bool,
        7 proxyIpAddress Ip, 8 proxyPort u32, 9 proxyNetPath str, 10 remoteIpAddress Ip, 11 remotePort u32,
        12 localIpAddress Ip, 13 localPort u32""",
    "CrossOpen": """1 type enum, 2 targetPid u32, 3 targetProcCreateTime u64, 4 requestedAccess u32,
        5 targetProcPath str, 6 targetProcMd5 bytes, 7 targetProcSha256 bytes""",
    "CrossThread": """1 remoteProcPid u32, 2 remoteProcCreateTime u64, 3 remoteProcPath str, 4 remoteProcMd5 bytes,
        5 remoteProcSha256 bytes""",
    "Crossproc": "1 open CrossOpen, 2 remotethread CrossThread, 3 tamper bool, 4 isTarget bool",
    "Blocked": """1 blockedType enum, 2 blockedEvent enum, 3 blockedmd5Hash bytes, 4 blockedPath str,
        5 blockResult enum, 6 blockError u32, 7 blockedPid i32, 8 blockedProcCreateTime u64, 9 blockedCmdline str,
        10 blockedUid str, 11 blockedUsername str""",
    "Module": """1 md5 bytes, 2 CopiedModuleLength u32, 3 OriginalModuleLength u64, 4 utf8_FileDescription str,
        5 utf8_CompanyName str, 6 utf8_ProductName str, 7 utf8_FileVersion str, 8 utf8_Comments str,
        9 utf8_LegalCopyright str, 10 utf8_LegalTrademark str, 11 utf8_InternalName str, 12 utf8_OriginalFileName str,
        13 utf8_ProductDescription str, 14 utf8_ProductVersion str, 15 utf8_PrivateBuild str, 16 utf8_SpecialBuild str,
        17 utf8_DigSig_Publisher str, 18 utf8_DigSig_ProgramName str, 19 utf8_DigSig_IssuerName str,
        20 utf8_DigSig_SubjectName str, 21 utf8_DigSig_Result str, 22 utf8_DigSig_ResultCode str,
        23 utf8_DigSig_SignTime str, 24 Icon bytes, 25 ImageFileHeader bytes, 26 utf8_OnDiskFilename str,
        27 sha256 bytes""",
    "Endpoint": "1 SensorId i32, 2 SensorHostName str, 3 HostId i64",
    "Server": "1 NodeId i32",
    "Env": "1 endpoint Endpoint, 2 server Server",
    "Tamper": "1 type enum, 2 tamper_sent bool",
    "EmetAction": "1 mitigationType enum",
    "Emet": "1 emetId u64, 2 emetTimstamp u64, 3 action EmetAction, 4 actionText str, 5 blocked bool",
    "Script": "1 script str, 2 sha256 str",
    "Event": """1 header Header!, 2 strings String*, 3 process Process, 4 modload Modload, 5 filemod Filemod,
        6 network Network, 7 regmod Regmod, 9 module Module, 12 childproc Childproc, 13 env Env,
        14 crossproc Crossproc, 15 tamperAlert Tamper, 16 blocked Blocked, 17 emet Emet, 18 netconnBlocked Network,
        20 networkv2 NetworkV2, 21 netconnBlockedv2 NetworkBlockedV2, 23 scriptexe Script""",
}

SPARK_TYPES = {
    "i32": T.IntegerType(),
    "i64": T.LongType(),
    "u32": T.LongType(),
    "u64": T.DecimalType(20, 0),
    "bool": T.BooleanType(),
    "bytes": T.BinaryType(),
    "str": T.StringType(),
    "enum": T.IntegerType(),
}


def fields(message: str) -> list[tuple[int, str, str, str]]:
    """``(number, name, type, label)`` of a message; the label is '' (optional), '!' (required) or '*' (repeated)."""
    parsed = []
    for entry in WIRE[message].split(","):
        number, name, kind = entry.split()
        label = kind[-1] if kind[-1] in "!*" else ""
        parsed.append((int(number), name, kind.rstrip("!*"), label))
    return parsed


@cache
def spark_type(message: str = "Event") -> T.StructType:
    out = T.StructType()
    for _, name, kind, label in fields(message):
        dtype = SPARK_TYPES.get(kind) or spark_type(kind)
        out.add(name, T.ArrayType(dtype) if label == "*" else dtype)
    return out


@cache
def message_class():
    """Protobuf class of the ``Event`` message, built from ``WIRE``; needs the protobuf runtime."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    kinds = {"i32": 5, "enum": 5, "i64": 3, "u32": 13, "u64": 4, "bool": 8, "str": 9, "bytes": 12}
    file = descriptor_pb2.FileDescriptorProto(name="sensor.proto", package="sensor", syntax="proto2")
    for message in WIRE:
        proto = file.message_type.add(name=message)
        for number, name, kind, label in fields(message):
            field = proto.field.add(name=name, number=number, label={"": 1, "!": 2, "*": 3}[label])
            if kind in kinds:
                field.type = kinds[kind]
            else:
                field.type = 11
                field.type_name = f".sensor.{kind}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("sensor.Event"))
