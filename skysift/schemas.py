"""Explicit schemas of the record tables."""

from __future__ import annotations

CANDIDATE = "candname string, ra_idx int, dec_idx int, wid_idx int, dm_idx int, toa int, period_s double, snr double, prob double"
#: Header names of candidate files, in column order; optional ones may be absent.
CANDIDATE_NAMES = {"candname": "candname", "RA index": "ra_idx", "DEC index": "dec_idx", "WIDTH index": "wid_idx", "DM index": "dm_idx", "TOA": "toa", "Period_s": "period_s", "SNR": "snr", "PROB": "prob"}
TRIGGER = "mjds double, isot string, snr double, ibox int, dm double, ibeam int, cntb int, cntc int, itime bigint, specnum bigint, ra double, dec double, trigname string, period double"
INJECTION = "isot string, dm double, width int, snr double"
RECOVERY = INJECTION + ", predict int, prob double"
NOISE = "dm double, width int, n bigint, noise double"
ANTENNA = "blank string, station string, lat double, lon double, elevation double"
VISIBILITY = "file string, mjd double, sb int, dec double, gulp int, t int, bl int, chan int, pol int, re double, im double"
PLAN = "mjd double, elevation double"
LEDGER = "file string, n_processed int, note string"
