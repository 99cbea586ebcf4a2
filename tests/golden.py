"""Fixed values the engine must reproduce."""

# Hourly volume of one day: sensor, junction, hour, vehicles, mean speed, index, level. The levels are
# data; those of index 65.0, 66.0, 67.8 and 68.2 differ from the rule.
HOURLY = [
    ("J001", "Galle Face", 6, 90, 42.1, 18.5, "LOW"),
    ("J001", "Galle Face", 7, 210, 18.5, 72.3, "SEVERE"),
    ("J001", "Galle Face", 8, 280, 12.1, 85.1, "SEVERE"),
    ("J001", "Galle Face", 9, 180, 28.0, 55.0, "MODERATE"),
    ("J001", "Galle Face", 10, 120, 38.0, 31.5, "LOW"),
    ("J001", "Galle Face", 12, 150, 33.0, 40.0, "MODERATE"),
    ("J001", "Galle Face", 17, 250, 15.3, 78.0, "SEVERE"),
    ("J001", "Galle Face", 18, 230, 19.0, 68.2, "SEVERE"),
    ("J001", "Galle Face", 20, 100, 40.0, 22.0, "LOW"),
    ("J002", "Pettah", 6, 60, 40.0, 15.0, "LOW"),
    ("J002", "Pettah", 7, 190, 22.0, 55.3, "MODERATE"),
    ("J002", "Pettah", 8, 310, 10.5, 89.2, "SEVERE"),
    ("J002", "Pettah", 9, 200, 25.0, 60.0, "MODERATE"),
    ("J002", "Pettah", 10, 130, 35.0, 35.0, "LOW"),
    ("J002", "Pettah", 12, 170, 28.0, 50.0, "MODERATE"),
    ("J002", "Pettah", 17, 240, 20.0, 65.0, "SEVERE"),
    ("J002", "Pettah", 18, 200, 23.0, 58.0, "MODERATE"),
    ("J002", "Pettah", 20, 80, 42.0, 18.0, "LOW"),
    ("J003", "Union Place", 6, 30, 52.0, 8.0, "LOW"),
    ("J003", "Union Place", 7, 90, 38.0, 22.5, "LOW"),
    ("J003", "Union Place", 8, 110, 32.0, 32.0, "LOW"),
    ("J003", "Union Place", 9, 95, 36.0, 25.5, "LOW"),
    ("J003", "Union Place", 12, 80, 40.0, 19.0, "LOW"),
    ("J003", "Union Place", 17, 130, 25.0, 47.2, "MODERATE"),
    ("J003", "Union Place", 18, 120, 28.0, 42.0, "MODERATE"),
    ("J003", "Union Place", 20, 50, 48.0, 10.0, "LOW"),
    ("J004", "Nugegoda", 6, 80, 38.0, 25.0, "LOW"),
    ("J004", "Nugegoda", 7, 230, 20.0, 67.8, "SEVERE"),
    ("J004", "Nugegoda", 8, 270, 14.0, 80.5, "SEVERE"),
    ("J004", "Nugegoda", 9, 190, 26.0, 57.0, "MODERATE"),
    ("J004", "Nugegoda", 10, 130, 36.0, 32.0, "LOW"),
    ("J004", "Nugegoda", 12, 140, 30.0, 42.5, "MODERATE"),
    ("J004", "Nugegoda", 17, 260, 17.5, 74.5, "SEVERE"),
    ("J004", "Nugegoda", 18, 240, 20.0, 66.0, "SEVERE"),
    ("J004", "Nugegoda", 20, 90, 40.0, 22.0, "LOW"),
]

CSV_HEADER = (
    "sensor_id,junction_name,hour,hour_label,total_vehicles,avg_speed_kmph,congestion_index,"
    "congestion_level"
)

PEAK_SECTION = """\
  J001 | Galle Face
    Peak Hour  : 08:00
    Vehicles   : 280
    Avg Speed  : 12.1 km/h
    Cong. Index: 85.1 (SEVERE)

  J002 | Pettah
    Peak Hour  : 08:00
    Vehicles   : 310
    Avg Speed  : 10.5 km/h
    Cong. Index: 89.2 (SEVERE)

  J003 | Union Place
    Peak Hour  : 17:00
    Vehicles   : 130
    Avg Speed  : 25.0 km/h
    Cong. Index: 47.2 (MODERATE)

  J004 | Nugegoda
    Peak Hour  : 08:00
    Vehicles   : 270
    Avg Speed  : 14.0 km/h
    Cong. Index: 80.5 (SEVERE)
"""

ALERT_LINES = """\
  J001 | Galle Face     | 07.2 km/h | 08:15 | CRITICAL
  J002 | Pettah         | 05.1 km/h | 08:35 | CRITICAL
  J004 | Nugegoda       | 08.9 km/h | 17:45 | CRITICAL"""

INTERVENTION_LINES = """\
  ⚠  J001 — Galle Face - Marine Drive  (Peak CI: 85.1 — SEVERE)
  ⚠  J002 — Pettah - Manning Market    (Peak CI: 89.2 — SEVERE)
  ⚠  J004 — Nugegoda - High Level Road (Peak CI: 80.5 — SEVERE)"""

# The text report of the sample windows in their own zone.
NIGHTLY_REPORT = """\
=================================================================
  TRAFFIC REPORT — 2025-07-15
  Generated by: nightly traffic report
=================================================================

PEAK TRAFFIC HOURS PER JUNCTION
-----------------------------------------------------------------
  J001 | Galle Face - Marine Drive
    Peak Hour  : 08:00–09:00
    Vehicles   : 280
    Avg Speed  : 12.1 km/h
    Cong. Index: 85.1

  J002 | Pettah - Manning Market
    Peak Hour  : 08:00–09:00
    Vehicles   : 310
    Avg Speed  : 10.5 km/h
    Cong. Index: 89.2

  J003 | Colombo 3 - Union Place
    Peak Hour  : 17:00–18:00
    Vehicles   : 130
    Avg Speed  : 25.0 km/h
    Cong. Index: 47.2

  J004 | Nugegoda - High Level Road
    Peak Hour  : 17:00–18:00
    Vehicles   : 260
    Avg Speed  : 17.5 km/h
    Cong. Index: 74.5


POLICE INTERVENTION RECOMMENDED TOMORROW
-----------------------------------------------------------------
  ⚠  J001 — Galle Face - Marine Drive
      Peak Hour : 08:00–09:00
      Reason    : CI=85.1 (≥60.0)

  ⚠  J002 — Pettah - Manning Market
      Peak Hour : 08:00–09:00
      Reason    : CI=89.2 (≥60.0)

  ⚠  J004 — Nugegoda - High Level Road
      Peak Hour : 17:00–18:00
      Reason    : CI=74.5 (≥60.0)

=================================================================
  END OF REPORT
=================================================================
"""

EMPTY_NIGHTLY_REPORT = """\
=================================================================
  TRAFFIC REPORT — 2025-07-16
  Generated by: nightly traffic report
=================================================================

PEAK TRAFFIC HOURS PER JUNCTION
-----------------------------------------------------------------
  No data available for today.

POLICE INTERVENTION RECOMMENDED TOMORROW
-----------------------------------------------------------------
  ✓ No junctions require police intervention tomorrow.
=================================================================
  END OF REPORT
=================================================================
"""
