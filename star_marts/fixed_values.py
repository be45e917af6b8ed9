"""Labels, word lists and column layouts that results must equal.

Nothing here is logic.  Lists are in file or natural order.
"""

from __future__ import annotations

# Null tokens of the header-driven CSV format.
NULL_TOKENS = ("", "NULL", "null")

# Label for stations that belong to no network.
NO_NETWORK = "Non-Networked"

# Region of each New York county; every other county is OTHER_REGION.
NY_REGIONS = {
    "NYC": ["NEW YORK", "KINGS", "QUEENS", "BRONX", "RICHMOND"],
    "Long Island": ["NASSAU", "SUFFOLK"],
    "Hudson Valley": ["WESTCHESTER", "ROCKLAND", "PUTNAM", "ORANGE", "DUTCHESS"],
    "Western NY": ["ERIE", "NIAGARA", "CHAUTAUQUA", "CATTARAUGUS", "ALLEGANY"],
    "Finger Lakes": ["MONROE", "ONTARIO", "WAYNE", "LIVINGSTON", "YATES", "SENECA"],
    "Central NY": ["ONONDAGA", "OSWEGO", "CAYUGA", "MADISON", "CORTLAND"],
    "Capital District": [
        "ALBANY", "RENSSELAER", "SCHENECTADY", "SARATOGA", "WASHINGTON", "WARREN",
    ],
}
OTHER_REGION = "Other NY"

# Utilisation tiers as (exclusive upper bound in percent, label).
UTILIZATION_TIERS = [
    (20, "0-20% (low)"),
    (40, "20-40%"),
    (60, "40-60% (healthy)"),
    (80, "60-80% (high)"),
]
TOP_UTILIZATION_TIER = "80%+ (saturated)"

# The 75 columns of the station export, in file order.
STATION_EXPORT_COLUMNS = [
    "fuel_type_code", "station_name", "street_address", "intersection_directions", "city",
    "state", "zip", "plus4", "station_phone", "status_code", "expected_date",
    "groups_with_access_code", "access_days_time", "cards_accepted", "bd_blends",
    "ng_fill_type_code", "ng_psi", "ev_level1_evse_num", "ev_level2_evse_num",
    "ev_dc_fast_count", "ev_other_info", "ev_network", "ev_network_web", "geocode_status",
    "latitude", "longitude", "date_last_confirmed", "id", "updated_at", "owner_type_code",
    "federal_agency_id", "federal_agency_name", "open_date", "hydrogen_status_link",
    "ng_vehicle_class", "lpg_primary", "e85_blender_pump", "ev_connector_types", "country",
    "intersection_directions_french", "access_days_time_french", "bd_blends_french",
    "groups_with_access_code_french", "hydrogen_is_retail", "access_code", "access_detail_code",
    "federal_agency_code", "facility_type", "cng_dispenser_num", "cng_on_site_renewable_source",
    "cng_total_compression_capacity", "cng_storage_capacity", "lng_on_site_renewable_source",
    "e85_other_ethanol_blends", "ev_pricing", "ev_pricing_french", "lpg_nozzle_types",
    "hydrogen_pressures", "hydrogen_standards", "cng_fill_type_code", "cng_psi",
    "cng_vehicle_class", "lng_vehicle_class", "ev_on_site_renewable_source",
    "restricted_access", "rd_blends", "rd_blends_french", "rd_blended_with_biodiesel",
    "rd_maximum_biodiesel_level", "nps_unit_name", "cng_station_sells_renewable_natural_gas",
    "lng_station_sells_renewable_natural_gas", "maximum_vehicle_class", "ev_workplace_charging",
    "funding_sources",
]

# The 20 columns of the registration export, in file order.
REGISTRATION_EXPORT_COLUMNS = [
    "record_type", "vin", "registration_class", "city", "state", "zip", "county", "model_year",
    "make", "body_type", "fuel_type", "unladen_weight", "maximum_gross_weight", "passengers",
    "reg_valid_date", "reg_expiration_date", "color", "scofflaw_indicator",
    "suspension_indicator", "revocation_indicator",
]

# Names given to the first 17 registration columns when they are cleaned.
CLEAN_REGISTRATION_COLUMNS = [
    "record_type", "vin_suffix", "registration_class", "city", "state", "zip", "county",
    "model_year", "make", "body_type", "fuel_type", "unladen_weight", "max_gross_weight",
    "passengers", "reg_valid_date", "reg_expiry_date", "color",
]

# Census exports end in one column without a name.
CENSUS_POPULATION_COLUMNS = [
    "geo_id", "name", "population_estimate", "population_moe", "unnamed_extra",
]
CENSUS_INCOME_COLUMNS = [
    "geo_id", "name", "median_income", "income_moe", "unnamed_extra",
]

# Session export columns and the header-named station columns in use.
SESSION_COLUMNS = [
    "session_id", "station_id", "session_date",
    "kwh_delivered", "duration_minutes", "revenue_usd",
]
STATION_FEED_COLUMNS = [
    "ID", "STATIONNAME", "EVNETWORK", "ZIP", "CITY", "STATE", "EVLEVEL1EVSENUM",
    "EVLEVEL2EVSENUM", "EVDCFASTCOUNT", "LATITUDE", "LONGITUDE", "STATUSCODE", "OPENDATE",
]
