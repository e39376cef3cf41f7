"""Caller parameters.

A frozen dataclass of literals: every value ends up as a literal inside a
Catalyst expression, so nothing has to be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class CallParams:
    # Defaults of the original command-line tool.
    freq: float = 0.05           # -f  minimum allele frequency
    minr: int = 2                # -r  minimum high-quality variant reads
    minb: int = 2                # -B  minimum reads per strand for the bias test
    goodq: float = 25.0          # -q  good base quality
    mismatch: int = 8            # -m  max mismatches (NM - indel length)
    trim: int = 0                # -T  trim bases after this read position (0 = off)
    read_pos_filter: int = 5     # -P  minimum mean read position
    qratio: float = 1.5          # -o  minimum high/low quality ratio
    mapq: float = 0.0            # -O  minimum mean mapping quality
    lofreq: float = 0.05         # -V  low-frequency cut for paired calls
    vext: int = 3                # -X  matching bases between the parts of a complex indel
    indelsize: int = 120         # -I  max indel size
    bias: float = 0.05           # strand-bias fraction
    buffer: int = 200            # soft-clip window around a region
    lowqual: int = 10            # low base quality for clip re-match
    min_mapq: int | None = None  # -Q  drop reads below this mapping quality
    samfilter: int | None = 0x500  # -F mask; the live path only drops 0x100
    apply_full_mask: bool = False  # D4: apply the whole samfilter mask
    remove_dups: bool = False    # -t
    minmatch: int = 0            # -M  minimum matched bases (M+I)
    downsample: float | None = None  # -Z fraction to drop (deterministic hash)
    realign: bool = True         # -k  local realignment; not available, so callers pass False
    adjust_mnp: bool = True      # E17: fragments and clips join their multi-base changes (always on in the original)
    normalize: bool = False      # D15 before the pileup (part of -k in the original)
    move_indels_3: bool = False  # -3
    pileup: bool = False         # -p  emit every position
    flank: int = 700             # reference flank loaded around a region
    amplicon_dist: int = 10      # amplicon distance (10:0.95)
    amplicon_overlap: float = 0.95

    def with_(self, **kw) -> "CallParams":
        return replace(self, **kw)

    @staticmethod
    def pileup_mode(**kw) -> "CallParams":
        """-p sets freq=-1 and minr=0."""
        return CallParams(pileup=True, freq=-1.0, minr=0, **kw)


DEFAULT = CallParams()
