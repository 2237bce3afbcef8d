"""Column roles of an event table.

Operators take the column *roles* they need as keyword arguments whose
defaults name the appointments view; any table with an entity id, a
booking time, an event day, a group column and a boolean outcome can be
passed by overriding them.
"""

ENTITY = "patient_id"
ROW_ID = "appointment_id"
BOOKED = "scheduled_ts"
DAY = "appointment_day"
GROUP = "neighbourhood"
LABEL = "no_show"
AGE = "age"
GENDER = "gender"
SMS = "sms_received"

# Patient attributes (everything describing the person, not the visit).
PROFILE_WITH_AGE = [ENTITY, GENDER, AGE, "scholarship", "hipertension", "diabetes",
                    "alcoholism", "handcap"]
PROFILE_WITHOUT_AGE = [ENTITY, GENDER, GROUP, "scholarship", "hipertension", "diabetes",
                       "alcoholism", "handcap"]
