"""Record layouts: column names with roles.

A layout is an ordered list of (name, role) pairs.  Roles are ``numeric``
(parsed to double), ``category`` (string, index-coded by a vocabulary),
``label`` (string) and ``text`` (string kept as is).  Operators take the
role lists from a layout, never positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

NUMERIC = "numeric"
CATEGORY = "category"
LABEL = "label"
TEXT = "text"


@dataclass(frozen=True)
class Layout:
    fields: tuple[tuple[str, str], ...]

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.fields]

    @property
    def numeric(self) -> list[str]:
        return [n for n, r in self.fields if r == NUMERIC]

    @property
    def categories(self) -> list[str]:
        return [n for n, r in self.fields if r == CATEGORY]

    @property
    def label(self) -> str | None:
        labels = [n for n, r in self.fields if r == LABEL]
        return labels[-1] if labels else None

    def struct_type(self, corrupt_col: str | None = None) -> T.StructType:
        fields = [T.StructField(n, T.DoubleType() if r == NUMERIC else T.StringType(), True)
                  for n, r in self.fields]
        if corrupt_col:
            fields.append(T.StructField(corrupt_col, T.StringType(), True))
        return T.StructType(fields)


def layout(*pairs: tuple[str, str]) -> Layout:
    return Layout(tuple(pairs))


# ---------------------------------------------------------------------------
# Fixed values of the connection-log format.  These must equal the source
# format exactly (field order, category vocabularies and class names decide
# index codes), so they are stated here as plain text, in their natural order.
# ---------------------------------------------------------------------------
CONNECTION_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes",
    "land", "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in",
    "num_compromised", "root_shell", "su_attempted", "num_root",
    "num_file_creations", "num_shells", "num_access_files", "num_outbound_cmds",
    "is_host_login", "is_guest_login", "count", "srv_count", "serror_rate",
    "srv_serror_rate", "rerror_rate", "srv_rerror_rate", "same_srv_rate",
    "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate",
    "dst_host_serror_rate", "dst_host_srv_serror_rate", "dst_host_rerror_rate",
    "dst_host_srv_rerror_rate", "label",
]
CONNECTION_CATEGORY_COLUMNS = ["protocol_type", "service", "flag"]

PROTOCOLS = ["icmp", "tcp", "udp"]
SERVICES = [
    "supdup", "domain", "http", "whois", "netstat", "netbios_dgm", "time", "smtp",
    "gopher", "private", "name", "ctf", "ntp_u", "red_i", "vmnet", "tim_i",
    "klogin", "nnsp", "mtp", "hostnames", "pop_2", "urp_i", "Z39_50", "eco_i",
    "ftp_data", "pm_dump", "systat", "ftp", "sql_net", "efs", "remote_job",
    "finger", "ldap", "kshell", "iso_tsap", "ecr_i", "nntp", "printer", "telnet",
    "uucp", "auth", "http_443", "tftp_u", "login", "echo", "sunrpc", "urh_i",
    "uucp_path", "daytime", "other", "pop_3", "netbios_ns", "shell", "domain_u",
    "courier", "exec", "rje", "link", "ssh", "netbios_ssn", "csnet_ns", "X11",
    "IRC", "bgp", "discard", "imap4",
]
FLAGS = ["S2", "RSTR", "OTH", "RSTO", "S1", "SH", "RSTOS0", "S3", "REJ", "S0", "SF"]
ATTACK_NAMES = [
    "normal", "back", "buffer_overflow", "ftp_write", "guess_passwd", "imap",
    "ipsweep", "land", "loadmodule", "multihop", "neptune", "nmap", "perl", "phf",
    "pod", "portsweep", "rootkit", "satan", "smurf", "spy", "teardrop",
    "warezclient", "warezmaster",
]
NORMAL_TOKEN = "normal"
LABEL_STRIP_CHARS = "."
# ---------------------------------------------------------------------------

CONNECTION_LAYOUT = Layout(tuple(
    (name, LABEL if name == "label"
     else CATEGORY if name in CONNECTION_CATEGORY_COLUMNS else NUMERIC)
    for name in CONNECTION_COLUMNS
))

CONNECTION_VOCABULARIES = {
    "protocol_type": PROTOCOLS,
    "service": SERVICES,
    "flag": FLAGS,
}
