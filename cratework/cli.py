"""Command line: ``python -m cratework.cli --store DIR --catalogue BASE --entities artist label --dump-month 2024-05``, or with
``--dump artist=PATH,DATE,SHA256 ...`` instead of a catalogue; options win over environment."""

from __future__ import annotations

import argparse
import os

from cratework import __version__
from cratework.plans.control import Progress
from cratework.plans.pipeline import WRITERS, ImportConfig, run_import
from cratework.plans.registry import ENTITIES
from cratework.session import build_session


def _env(name: str, default: str | None = None) -> str | None:
    return os.environ.get(f"CRATEWORK_{name}", default)


def _singular(entity: str) -> str:
    return entity.strip().lower().removesuffix("s")


def parse(argv: list[str] | None = None) -> ImportConfig:
    p = argparse.ArgumentParser(prog="cratework")
    p.add_argument("--store", default=_env("STORE"), required=_env("STORE") is None)
    p.add_argument("--dump", action="append", default=(_env("DUMPS") or "").split() or None, help="entity=path,date,sha256")
    p.add_argument("--entities", "-e", nargs="+", default=(_env("ENTITIES") or "").replace(",", " ").split() or list(ENTITIES), help="entities to import (default: all)")
    p.add_argument("--dump-month", "-m", default=_env("DUMP_MONTH"), help="exact month, yyyy-mm (default: the latest dump of each entity)")
    p.add_argument("--catalogue", default=_env("CATALOGUE"), help="address of the dump catalogue, or a local copy")
    p.add_argument("--data-dir", default=_env("DATA_DIR", os.path.join(os.path.expanduser("~"), ".cache", "cratework")))
    p.add_argument("--max-workers", type=int, default=int(_env("MAX_WORKERS", "0")) or WRITERS, help="tables written at a time")
    p.add_argument("--chunk-size", "-b", type=int, default=int(_env("CHUNK_SIZE", "5000")))
    p.add_argument("--partitions", type=int, default=int(_env("PARTITIONS", "0")) or None)
    p.add_argument("--force", "-f", action="store_true", default=_env("FORCE") == "true")
    p.add_argument("--allow-downgrade", action="store_true", default=_env("ALLOW_DOWNGRADE") == "true")
    p.add_argument("--cleanup", "-c", action="store_true", default=_env("CLEANUP") == "true")
    p.add_argument("--version", "-v", action="version", version=__version__)
    a = p.parse_args(argv)
    dumps = {}
    for d in a.dump or []:
        entity, _, rest = d.partition("=")
        path, date, checksum = rest.rsplit(",", 2)
        dumps[_singular(entity)] = (path, date, checksum)
    entities = () if dumps else tuple(dict.fromkeys(_singular(e) for x in a.entities for e in x.split(",")))
    return ImportConfig(
        a.store, dumps, entities, a.dump_month, a.catalogue, a.data_dir, a.max_workers, chunk_size=a.chunk_size,
        partitions=a.partitions, force=a.force, allow_downgrade=a.allow_downgrade, cleanup=a.cleanup,
    )


def main(argv: list[str] | None = None) -> None:
    config = parse(argv)
    config.validate()
    print(run_import(build_session(), config, Progress(print)))


if __name__ == "__main__":
    main()
