"""Fixture trees and archives."""

import io
import tarfile
import zipfile

NODE = "3100000042/north-wing/host-07/2021-2022"
COMMANDS = "uptime of bycast host\nstorage-grid-release-12.7.3-20210917.1100.cafe77\nload is low\n"
LOOSE = ["kern.txt", "syslog.2", "notes.log"]


def golden_tree(root, put):
    """A node in a case, the same outside any case, a case with a loose product log, and one with others as well."""
    for top in ("42", NODE):
        put(root, f"{top}/lumberjack.log", "bycast marker\n")
        put(root, f"{top}/services/dmesg.txt", "bycast kernel up\n")
        put(root, f"{top}/system_commands", COMMANDS)
    put(root, "Elsewhere/readme.txt", "nothing of interest")
    put(root, "3100000043/bycast.log", "loose bycast line")
    for name in LOOSE:
        put(root, f"3100000043/{name}", f"about {name}")
    for name in ("bycast.log", "todo.txt", "other.log"):
        put(root, f"3100000044/{name}", f"{name.removesuffix('.log')} again\n")


def tar(members, mode="w"):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as archive:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, data in members.items():
            archive.writestr(name, data)
    return out.getvalue()
