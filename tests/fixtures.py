"""Hand-made inputs with exact expected values (see FIXTURES.md part 1)."""

from wardstat.schemas import MEASURE_CODES, RAW_FIELDS

CODES = list(MEASURE_CODES)
CONST = {"footnote": "", "number_of_readmissions": "20",
         "start_date": "07/01/2021", "end_date": "06/30/2024"}


def row(fid, name, state, code, ratio, pred="10.0", exp="11.1", dis="200"):
    d = {"facility_id": fid, "facility_name": name, "state": state, "measure_name": code,
         "number_of_discharges": dis, "excess_readmission_ratio": ratio,
         "predicted_readmission_rate": pred, "expected_readmission_rate": exp, **CONST}
    return tuple(d[c] for c in RAW_FIELDS)


# One hospital for each case.
LOW, HIGH, PARTIAL, EVEN, BLANK, RATES = "030114", "190260", "360078", "520009", "470533", "110845"
LOW_RATIOS = ["0.81", "0.83", "0.85", "0.87", "0.89", "0.91"]


def raw_rows():
    rows = []
    # below 1.0 on every measure, mean 0.86 -> label 0
    rows += [row(LOW, "Mesa Clinic", "AZ", c, x, "14.2", "16.5", "310") for c, x in zip(CODES, LOW_RATIOS)]
    # above 1.0 on every measure -> label 1; discharges suppressed for one
    rows += [row(HIGH, "Bayou General", "LA", c, "1.23", "17.3", "14.1",
                 "Too Few to Report" if i == 0 else "88") for i, c in enumerate(CODES)]
    # two of six ratios missing -> 4 valid measures, label 0
    rows += [row(PARTIAL, "Lakeshore Hospital", "OH", c, "N/A" if i < 2 else "0.97", "15.5", "16.0", "61")
             for i, c in enumerate(CODES)]
    # unknown measure, dropped
    rows.append(row(PARTIAL, "Lakeshore Hospital", "OH", "READM-30-UNKNOWN-HRRP", "7.7"))
    # duplicates of (hospital, measure) average to 1.0, all others are 1.0:
    # mean exactly 1.0 -> label 0 (strict >)
    rows.append(row(EVEN, None, "wi", CODES[0], "0.7"))
    rows.append(row(EVEN, "Dells Medical", "wi", CODES[0], "1.3"))
    rows += [row(EVEN, "Dells Medical", "wi", c, "1.0") for c in CODES[1:]]
    # all 24 values missing -> vanishes
    rows += [row(BLANK, "Green Ridge", "VT", c, "N/A", "N/A", "N/A", "Too Few to Report") for c in CODES]
    # rates but no ratio -> in the wide table, dropped by the label step
    rows += [row(RATES, "Peach Valley", None, c, "N/A", "13.7", "12.9", "47") for c in CODES]
    # null facility id -> dropped
    rows.append(row(None, "Nobody", "AZ", CODES[0], "1.5"))
    return rows


EDGE_STRINGS = {
    " 1.5 ": 1.5, "1e3": 1000.0, ".5": 0.5, "-2": -2.0, "+3.25": 3.25, "inf": float("inf"),
    "1.5d": None, "NaN": None, "1,000": None, "5%": None, "": None, "N/A": None,
    "Too Few to Report": None, "0x1p3": None, "abc": None,
}
