from .adapters import feed_from_events, load_event_tables, messages_from_events
from .tables import (FEED_SCHEMA, MESSAGE_SCHEMA, read_feed_actions, read_jdbc,
                     read_message_actions, read_table)

__all__ = ["FEED_SCHEMA", "MESSAGE_SCHEMA", "feed_from_events", "load_event_tables",
           "messages_from_events", "read_feed_actions", "read_jdbc",
           "read_message_actions", "read_table"]
