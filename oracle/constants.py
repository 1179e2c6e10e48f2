"""Fixed values, written out here on their own: no query of the library gives the oracle its constants."""

# Journeys of item-list codes, in order of trial; the pages and texts that go with them.
JOURNEY_RULES = (("PSUCMM-AIM%", "AIM U - SWITCH"), ("SUCMM-AIM%", "AIM U"), ("PXSUCMM-AIM%", "AIM U - SWITCH"), ("XSUCMM-AIM%", "AIM U"),
 ("%-AIM%", "AIM"), ("PSCMM-AIM%", "AIM - SWITCH"), ("SUCMM%", "CAM WAVES U"), ("SUCMM-MAN%", "CAM WAVES U"),
 ("XSUCMM%", "CAM WAVES U"), ("SUCMM-NONCAM%", "CAM WAVES U"), ("PSUCMM%", "CAM WAVES U - SWITCH"),
 ("PSUCMM-MAN%", "CAM WAVES U - SWITCH"), ("PXSUCMM%", "CAM WAVES U - SWITCH"), ("PSUCMM-NONCAM%", "CAM WAVES U - SWITCH"),
 ("XSUCMM-NONCAM%", "CAM U"), ("SUCMM-NONCAM%", "CAM U"), ("XUCMM-NONCAM%", "CAM U"), ("PXSUCMM-NONCAM%", "CAM U - SWITCH"),
 ("PSUCMM-NONCAM%", "CAM U - SWITCH"), ("PXUCMM-NONCAM%", "CAM U - SWITCH"), ("UCMM%", "CAM U"), ("XUCMM%", "CAM U"),
 ("UCMM-NONCAM%", "CAM U"), ("PUCMM%", "CAM U - SWITCH"), ("PXUCMM%", "CAM U - SWITCH"), ("PUCMM-NONCAM%", "CAM U - SWITCH"),
 ("SCMM%", "CAM WAVES"), ("PSCMM%", "CAM WAVES - SWITCH"), ("CMM%", "CAM"), ("PCMM%", "CAM - SWITCH"))
EXCLUDED_PAGES = ("fitfast", "truck", "manufacturer", "seasonal", "runflat", "reinforced", "loadratings", "carmanufacturer", "speedratings",
 "staging", "inforgen")
DEFAULT_JOURNEY = "NON MERCH VRM"
NO_REGISTRATION = "NO VRM SEARCH"
SIZE_JOURNEY = "SIZE"
# Points of labels, and percentiles of tiers.
LETTER_POINTS = (("A", 10.0), ("B", 9.0), ("C", 5.0), ("D", 2.5), ("E", 1.0))
NOISE_POINTS = (("-A", 10.0), ("-B", 5.0), ("-C", 1.0))
TIERS = ((25, "1.BEST TYRE SCORE"), (50, "2.BETTER TYRE SCORE"), (75, "3.GOOD TYRE SCORE"), (90, "4.FAIR TYRE SCORE"))
# Columns of the scored table, and the headers they have in a text block.
COLUMNS = ("TyreScore", "ProductId", "GRADE", "BRAND", "Model", "WET_GRIP", "FUEL", "NOISE_REDUCTION", "SEASONAL_PERFORMANCE", "OE",
 "AWARD_SCORE", "RunflatStatus", "Segment", "PRICE_pct", "GRADE_pct", "FUEL_pct", "WET_GRIP_pct", "AWARD_SCORE_pct", "Vehicle",
 "SIZE", "PRICE", "OFFER", "PRICEFLUCTUATION", "Orders", "Units", "GoldilocksZone", "PremiumShare", "MidRangeShare",
 "BudgetShare", "RunflatShare", "SalesStatus", "PRODUCTLISTVIEWS", "CLICKSTREAMRATE")
BLOCK_HEADERS = ("TyreScore", "ProdID", "WetGrade", "Brand", "Model", "WetVal", "FuelVal", "NoiseVal", "Season", "IsOE", "AwardScore",
 "IsRunflat", "Segment", "PriceScore", "WetScore", "FuelScore", "WetScorePct", "AwardScorePct", "Vehicle", "Size", "PriceGBP",
 "IsOffer", "PriceFluct", "Orders", "Units", "Goldilocks", "PremShare", "MidShare", "BudShare", "RFShare", "Status", "Views",
 "ClickRate")
INFLUENCE = ("Segment", "PRICE_pct", "GRADE_pct", "FUEL_pct", "WET_GRIP_pct", "AWARD_SCORE_pct")
# Brands allowed in the first hotboxes, and those that the later ones add.
BRANDS_A = ("Avon", "BFGoodrich", "Bridgestone", "Continental", "Cooper", "Dunlop", "Falken", "Firestone", "General", "Goodyear", "Hankook",
 "Kumho", "Lassa", "Maxxis", "Metzeler", "Michelin", "Nankang", "Nokian", "Pirelli", "Sumitomo", "Toyo", "Uniroyal", "Vredestein",
 "Yokohama")
BRANDS_B_ONLY = ("Accelera", "Dynamo", "Tomket", "Triangle", "Zeetex")
# Names of the test tables' products, vehicles and codes.
BRANDS = ("Avon", "Bridgestone", "Continental", "Cooper", "Dunlop", "Falken", "Firestone", "Goodyear", "Hankook", "Kumho", "Maxxis",
 "Michelin", "Nankang", "Nokian", "Pirelli", "Toyo", "Uniroyal", "Vredestein", "Yokohama", "Accelera", "Dynamo", "Triangle",
 "Zeetex", "Nobrand", "Otherbrand")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CODES = ("PSUCMM-AIM1", "SUCMM-AIM1", "pxsucmm-aim", "XSUCMM-AIM", "CMM-AIM7", "PSCMM-AIM", "SUCMM-MAN1", "XSUCMM-NONCAM",
 "PSUCMM-NONCAM", "PXSUCMM", "XUCMM-NONCAM", "PXUCMM-NONCAM", "UCMM", "PUCMM", "SCMM", "pscmm", "CMM", "PCMM", "NONCAM", "OTHER",
 None, None)
ID_BASE = 10000000
# Rank of a product and the slot number it takes; the first four ranks take two slots.
SLOT_LAYOUT = ((1, 1.001), (2, 2.001), (3, 3.001), (4, 4.001), (5, 5.001), (6, 6.001), (7, 7.001), (8, 8.001), (1, 9.001), (9, 10.001),
 (10, 11.001), (11, 12.001), (2, 13.001), (12, 14.001), (13, 15.001), (14, 16.001), (3, 17.001), (15, 18.001), (16, 19.001),
 (17, 20.001), (4, 21.001), (18, 22.001), (19, 23.001), (20, 24.001), (21, 25.001), (22, 26.001), (23, 27.001), (24, 28.001),
 (25, 29.001), (26, 30.001), (27, 31.001), (28, 32.001), (29, 33.001), (30, 34.001), (31, 35.001), (32, 36.001), (33, 37.001),
 (34, 38.001), (35, 39.001), (36, 40.001), (37, 41.001), (38, 42.001), (39, 43.001), (40, 44.001), (41, 45.001), (42, 46.001),
 (43, 47.001), (44, 48.001), (45, 49.001), (46, 50.001), (47, 51.001), (48, 52.001), (49, 53.001), (50, 54.001), (51, 55.001),
 (52, 56.001), (53, 57.001), (54, 58.001), (55, 59.001), (56, 60.001))
