"""Fixed values of the practice system that reports select on, as SQL list text."""

# Appointment types (fixed values).
GLASSES_TYPES = "'CD','CF','CFD','DB','DBV','IC','ICY','LC','LCD','LCV','LDB','LDF','SC','SCY','SDF'"
LENS_TYPES = "'CDF','CL','CLD','CLV'"
LENS_TEACH_TYPES = "'LT','TDF','LTD','LTM','LTF'"
REFIT_TYPES = "'AL','SL'"
NOT_A_VISIT = "'BRK','LUN','REP','SP'"
NOT_BOOKABLE = "'SP','LUN','BRK'"

# Appointment progress: completed. Invoice types: 2 sale, 6 return.
DONE = "APP_PROGRESS = 5"
SALE = "TYPE = 2"
RETURN = "TYPE = 6"
EITHER = "TYPE in (2, 6)"

# Stock types: 2 frame, 3 sunglasses, 4 spectacle lens, 5 contact lens.
SPECTACLES = "STOCK_TYPE in (2, 3, 4)"
CONTACT_LENSES = "STOCK_TYPE = 5"

NET_AMOUNT = "QTY * UNITPRICE - DISCOUNT_AMOUNT"
