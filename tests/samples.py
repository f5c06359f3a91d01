"""Two sample texts of the tests: one with a multi-byte letter, one edited copy (distance 5)."""

ORIGINAL = (
    "Harbour pilots bring every ferry past the sandbank before the evening tide turns. \n"
    "Café owners on the quay count the lights of 14 trawlers and set out chairs for their crews. \n"
    "Tickets for the island boat are sold at the wooden kiosk until seven, cash only. \n"
    "When fog rolls in, a bell on the breakwater rings twice each minute.")

EDITED = (ORIGINAL.replace("evening tide", "morning tide").replace("wooden kiosk", "painted kiosk")
          .replace("a bell", "the bell"))
