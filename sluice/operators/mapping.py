"""Field mapping (rename and copy) and computed columns, neither of which replaces a
value that is already there."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators import expressions

log = logging.getLogger("sluice")


@dataclass(frozen=True)
class Rule:
    destination: str
    sources: tuple[str, ...]
    action: str = "rename"  # or copy

    def __post_init__(self):
        if self.action not in ("rename", "copy"):
            raise ValueError(f"unknown mapping action {self.action}")


def _copies(table: str) -> tuple[Rule, ...]:
    """Rules that copy, a line each: the destination, then the sources in order."""
    return tuple(Rule(d, tuple(s), "copy") for d, *s in (line.split() for line in table.strip().splitlines()))


#: Our own presets: names of the public schemas, and what event sources often call them.
PRESETS = {
    "ecs": _copies("""
        event.action action event_action operation
        event.outcome outcome result status
        event.category category event_category
        event.code event_id eventid code
        event.duration duration elapsed
        event.reason reason
        message message msg text
        log.level level severity loglevel
        log.logger logger logger_name
        host.name hostname host computer_name
        host.ip host_ip
        host.os.name os os_name platform
        agent.name agent agent_name
        agent.version agent_version
        user.name username user account
        user.id user_id uid
        user.domain domain user_domain
        user.email email mail
        source.ip src_ip client_ip source_ip
        source.port src_port source_port client_port
        source.mac src_mac
        source.bytes bytes_out sent_bytes
        destination.ip dst_ip dest_ip destination_ip server_ip
        destination.port dst_port dest_port destination_port
        destination.mac dst_mac dest_mac
        destination.bytes bytes_in received_bytes
        network.protocol protocol app_protocol
        network.transport transport proto
        url.full url uri
        url.path path url_path
        url.domain url_host
        http.request.method method http_method
        http.response.status_code status_code http_status
        user_agent.original user_agent useragent
        process.name process process_name
        process.pid pid process_id
        process.command_line command command_line cmdline
        process.parent.pid ppid parent_pid
        file.path file file_path
        file.hash.sha256 sha256 file_sha256
        file.size file_size
        dns.question.name query dns_query
        rule.name rule rule_name signature
        service.name service app application
        error.message error error_message
    """),
    "ocsf": _copies("""
        activity_name action operation
        status outcome result
        severity severity level
        message message msg
        duration duration elapsed
        src_endpoint.ip src_ip client_ip source_ip
        src_endpoint.port src_port source_port
        src_endpoint.mac src_mac
        dst_endpoint.ip dst_ip dest_ip destination_ip
        dst_endpoint.port dst_port dest_port destination_port
        device.hostname hostname host computer_name
        device.os.name os os_name
        actor.user.name username user account
        actor.user.uid user_id uid
        actor.user.email_addr email mail
        actor.process.name process process_name
        actor.process.pid pid process_id
        actor.process.cmd_line command command_line
        file.name file_name
        file.path file file_path
        http_request.http_method method http_method
        http_request.url.url_string url uri
        http_request.user_agent user_agent useragent
        http_response.code status_code http_status
        query.hostname query dns_query
        connection_info.protocol_name protocol proto
        traffic.bytes_in bytes_in received_bytes
        traffic.bytes_out bytes_out sent_bytes
    """),
    "cim": _copies("""
        src src_ip source_ip client_ip
        src_port source_port client_port
        src_mac source_mac
        dest dest_ip destination_ip dst_ip
        dest_port destination_port dst_port
        dest_mac destination_mac dst_mac
        dvc device host hostname
        user username account
        user_id uid
        src_user source_user
        action event_action outcome
        signature rule alert rule_name
        severity level priority
        app application service
        protocol app_protocol
        transport proto
        bytes_in received_bytes
        bytes_out sent_bytes
        http_method method
        http_user_agent user_agent useragent
        status status_code http_status
        uri_path url_path path
        url uri
        process process_name
        process_id pid
        file_hash sha256 md5
        file_path file
        query dns_query
    """),
    "beats": (Rule("host", ("hostname", "beat.hostname")), Rule("message", ("msg", "log")), Rule("source", ("log.file.path", "path")), Rule("agent", ("beat.name",)), Rule("agent_version", ("beat.version",)), Rule("level", ("severity", "log.level")), Rule("tags", ("labels",)), Rule("event_id", ("winlog.event_id",)), Rule("channel", ("winlog.channel",))),
}
ALIASES = {"splunk": "cim", "splunk_cim": "cim", "beats_legacy": "beats"}


def merge_rules(*layers: tuple[Rule, ...], columns: list[str] | None = None) -> tuple[Rule, ...]:
    """Later layers replace the rule of a destination; rules for unknown columns go."""
    found = {r.destination: r for layer in layers for r in layer}
    return tuple(r for r in found.values() if columns is None or r.destination in columns)


def preset(name: str) -> tuple[Rule, ...]:
    name = ALIASES.get(name, name)
    if name not in PRESETS:
        raise ValueError(f"no mapping preset {name}")
    return PRESETS[name]


def apply_mapping(df: DataFrame, rules: tuple[Rule, ...], keep: tuple[str, ...] = (), types: dict[str, str] | None = None) -> DataFrame:
    """Each rule fills its destination, where that is null, from the first source that is
    there.  A renamed source is null on the rows where the rule took it, and is dropped if
    no other rule reads it and it is not one of ``keep``.  ``types`` names the types of
    destinations; a source that such a type can't hold counts as not there."""
    types = types or {}
    made, taken = {}, {}
    for r in rules:
        sources = [s for s in r.sources if s in df.columns]
        if not sources:
            continue
        cast = lambda c, r=r: c.try_cast(types[r.destination]) if r.destination in types else c
        own = [F.col(f"`{r.destination}`")] if r.destination in df.columns else []
        values = [cast(F.col(f"`{s}`")) for s in sources]
        made[r.destination] = F.coalesce(*own, *values)
        if r.action == "rename":
            for k, s in enumerate(sources):
                before = F.coalesce(*own, *values[:k]).isNull() if own or k else F.lit(True)
                if s != r.destination:
                    taken[s] = taken.get(s, F.lit(False)) | (before & values[k].isNotNull())
    gone = {s for s in taken if s not in keep}
    left = {s: F.when(~taken[s], F.col(f"`{s}`")) for s in taken if s not in gone and s not in made}
    kept = [left.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns if c not in made and c not in gone]
    return df.select(*kept, *[v.alias(k) for k, v in made.items()])


def names_in(text: str) -> list[str]:
    """The fields that an expression names; none if it can't be read."""
    try:
        return expressions.names(expressions.parse(text))
    except ValueError:
        return []


def compute(df: DataFrame, columns: dict[str, str], texts: tuple[str, ...] = (), types: dict[str, str] | None = None, failures: str | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with computed columns, all over the columns as they came in, and the names
    of those that could not be compiled, which are left out.  A value already there
    stays, and its expression counts for nothing on that row; one that fails on a row
    leaves the column empty there.  ``texts`` are columns that hold any kind of value as
    text.  ``types`` names the types of the columns; a value that such a type can't hold
    counts as not there.  ``failures`` names an array column for the computed columns
    that failed on the row."""
    made, failed, types, wrong = {}, [], types or {}, []
    compiler = expressions.Compiler(df.schema, texts)
    for name, text in columns.items():
        try:
            term = compiler.compile(text)
            value = expressions.finished(term, types.get(name))
            df.select(value)  # binds the types now, so that one bad column is left out alone
        except (ValueError, AnalysisException) as e:
            log.warning("computed column %s is left out: %s", name, str(e).split("\n")[0])
            failed.append(name)
            continue
        own = F.col(f"`{name}`") if name in df.columns else F.lit(None)
        made[name] = F.coalesce(own, value) if name in df.columns else value
        if not term.null:
            wrong.append(F.when(own.isNull() & value.isNull(), F.lit(name)))
    if failures:
        made[failures] = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in made], *[v.alias(k) for k, v in made.items()]), failed
