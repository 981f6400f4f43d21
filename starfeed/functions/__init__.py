from starfeed.functions.calendar import calendar_columns, to_day
from starfeed.functions.messages import message_fields
from starfeed.functions.payments import paid_in_crypto

__all__ = ["calendar_columns", "message_fields", "paid_in_crypto", "to_day"]
