"""Small frames for unit tests."""

from __future__ import annotations

from starmart import schemas as S

COMPLETE_ARRIVAL = {
    "cicid": 6.0, "i94yr": 2016.0, "i94mon": 4.0, "i94cit": 692.0, "i94res": 692.0, "i94port": "XXX",
    "arrdate": 20573.0, "i94mode": 1.0, "i94addr": "CA", "depdate": 20582.0, "i94bir": 37.0,
    "i94visa": 2.0, "count": 1.0, "dtadfile": "20160429", "visapost": "ABC", "occup": "DEF",
    "entdepa": "T", "entdepd": "O", "entdepu": "U", "matflag": "M", "biryear": 1979.0,
    "dtaddto": "10282016", "gender": "F", "insnum": "1", "airline": "AA", "admnum": 1234567890.0,
    "fltno": "00011", "visatype": "B2",
}


def arrivals(spark, *changes):
    """One raw arrival per argument: the complete one with these values changed."""
    rows = [{**COMPLETE_ARRIVAL, **change} for change in changes]
    return spark.createDataFrame(
        [tuple(r[c.source] for c in S.ARRIVALS) for r in rows], S.ARRIVALS_SCHEMA
    )


def rows_of(df):
    """All rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


# Lines in the forms such a dictionary has.
DICTIONARY = """libname library 'somewhere' ;
/* CIT - codes */
  value i94cntyl
   582 =  'MEXICO Air Sea, and Not Reported (no land arrivals)'
   108 =  'DENMARK'
   209 =  'JAPAN'
   997 =  'INVALID: STATELESS'
   996 =  'INVALID: STATELESS'
   849 =  'No Country Code (849)' ;

/* PORT - codes */
  value $i94prtl
   'ALC'\t=\t'ALCAN, AK             '
   'CP '\t=\t'No PORT Code (CP)'
   'NK' \t=\t'No PORT Code (NK)'
;
value i94model
\t1 = 'Air'
\t2 = 'Sea'
\t9 = 'Not reported' ;
\t
value i94addrl
\t'AL'='ALABAMA'
\t'CA'='CALIFORNIA'
\t'WI'='WISCONSON' 
\t'99'='All Other Codes' ;
run ;
"""
