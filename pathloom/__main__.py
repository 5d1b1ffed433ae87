"""``python -m pathloom job.json``: run a declared job until it is stopped."""

import sys

from pathloom.streaming.job import JobSpec, build_session, run


def main(arguments: list[str]) -> None:
    if len(arguments) != 1:
        raise SystemExit("usage: python -m pathloom job.json")
    spec = JobSpec.from_file(arguments[0])
    run(build_session(spec), spec).awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
