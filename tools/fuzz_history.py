"""Randomised check of the history operator against a brute-force scan.

Draws window lengths, segment widths, tie rates and row counts, and
compares every row's history with tests/test_history.py's brute force.
Usage: python tools/fuzz_history.py [cases] [seed]
"""
import os
import random
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

import test_history as th  # noqa: E402

from txnguard.params import RuleParams  # noqa: E402
from txnguard.session import local_session  # noqa: E402


def main():
    cases = int(sys.argv[1]) if len(sys.argv) > 1 else 40
    rnd = random.Random(int(sys.argv[2]) if len(sys.argv) > 2 else 2024)
    spark = local_session()
    t0 = time.time()
    for case in range(cases):
        p = RuleParams(velocity_window_minutes=rnd.choice([1, 5, 10, 60, 360, 1440]),
                       card_test_window_minutes=rnd.choice([1, 5, 30, 1440]),
                       history_segment_minutes=rnd.choice([1, 7, 30, 90, 1440]))
        customers = ["a", "b", "c", "d"][:rnd.randint(1, 4)]
        rows = th.make_rows(rnd.randint(5, 150), customers,
                            span_minutes=rnd.choice([30, 600, 5000]), seed=case,
                            tie_rate=rnd.choice([0, 0.3]))
        th.check(spark, rows, p)
    print(f"{cases} cases equal to brute force in {time.time() - t0:.1f} s")


if __name__ == "__main__":
    main()
