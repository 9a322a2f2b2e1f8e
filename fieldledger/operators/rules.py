"""Which column a source field becomes, decided from its profile and fixed rules.

A profile says what a field looks like (type, keys of its first object). The
rules below say what to do with it: leave it out, spread it over columns, take
one key of an object, rename it, give it a type. ``field_plan`` settles one
field; ``resource_plan`` a whole feed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from fieldledger.functions.text import snake_name

# Fields left out of every feed.
DROPPED_EVERYWHERE = frozenset({"uri"})
SKIPPED_EVERYWHERE = frozenset({"tags", "offices"})

# Columns an address object is spread over.
ADDRESS_COLUMNS = {
    "street": "address_street",
    "city": "address_city",
    "state": "address_state",
    "postalCode": "address_postal",
}

# Renames that hold in every feed.
COMMON_NAMES = {
    "created": ("created_at", "timestamp"),
    "updated": ("updated_at", "timestamp"),
    "phoneNumber": ("phone", None),
    "externalIds": ("external_ids", "text"),
}

# Integer fields that hold epoch seconds.
TIMESTAMP_FIELDS = frozenset(
    "completedOn dueAfter dueBy dueDate endsOn expiresOn firstEnd firstStart latestAccepted"
    " latestClockIn latestSubmission reportedOn respondBy scheduledDate transactionDate windowEnd"
    " windowStart".split()
)

# Fields whose sampled type misleads.
CORRECTED_TYPES = {"subtotal": "real", "estimatedPrice": "real", "orderIndex": "integer"}

# Flags that get an is_ in front.
FLAG_NAMES = {
    "customer": "is_customer",
    "vendor": "is_vendor",
    "partsVendor": "is_parts_vendor",
    "primeContractor": "is_prime_contractor",
    "paid": "is_paid",
    "sent": "is_sent",
}


@dataclass(frozen=True)
class Field:
    """What happens to one source field."""

    source: str
    column: str | None = None
    type: str | None = None
    key: str | None = None
    spread: Mapping[str, str] = field(default_factory=dict)
    skip: bool = False

    @property
    def target(self) -> str:
        return self.column or snake_name(self.source)


@dataclass(frozen=True)
class Overrides:
    """Per-feed knowledge, as space-separated field names.

    ``skip``: not stored. ``ids``: objects stored by their id (the column gets
    ``_id``). ``reals``/``integers``/``texts``/``times``: given types.
    ``names``: given columns. ``literal``: never read as an object with an id.
    """

    description: str = ""
    skip: str = ""
    ids: str = ""
    reals: str = ""
    integers: str = ""
    texts: str = ""
    times: str = ""
    names: Mapping[str, str] = field(default_factory=dict)
    literal: str = ""
    skip_feed: bool = False

    def fields(self) -> dict[str, Field]:
        found: dict[str, Field] = {}

        def put(names: str, **change) -> None:
            for name in names.split():
                found[name] = replace(found.get(name, Field(name)), **change)

        put(self.skip, skip=True)
        for name in self.ids.split():
            put(name, key="id", type="integer", column=f"{snake_name(name)}_id")
        put(self.reals, type="real")
        put(self.integers, type="integer")
        put(self.texts, type="text")
        put(self.times, type="timestamp")
        for name, column in self.names.items():
            put(name, column=column)
        return found

    def known(self) -> set[str]:
        """Fields with any override at all."""
        return set(self.fields()) | set(self.literal.split())


# Knowledge about single feeds.
FEEDS = {
    "serviceline": Overrides("Trade categories", names={"icon": "icon_url"}, literal="trade abbr"),
    "company": Overrides(
        "Customer or vendor business", skip="managingAccount shareId serviceLinesProvided logo"
    ),
    "location": Overrides(
        "Service address of a company",
        skip="offices remitToAddress",
        ids="taxGroup brand",
        integers="legacyId",
        names={
            "generalManager": "general_manager",
            "storeNumber": "store_number",
            "remitToSource": "remit_to_source",
        },
        literal="generalManager",
    ),
    "contact": Overrides(
        "Person of a company or location", skip="type companies locations company location", texts="types"
    ),
    "job": Overrides(
        "Work order",
        skip="offices tags appointments displaySubstatus",
        ids="sales project",
        integers="percentComplete",
        texts=(
            "visibility sectionVisibilities serviceLinkAttachmentCategoryVisibility customName"
            " substatus ivrActivity"
        ),
        names={"serviceLine": "service_line", "currentAppointment": "current_appointment_id", "ivrOpen": "ivr_open"},
        literal="jobTypeWeight serviceLine scheduledDate estimatedPrice",
    ),
    "appointment": Overrides("Booked time of a job", skip="serviceRequests techs offices"),
    "invoice": Overrides(
        "Bill to a customer",
        skip="terms items tags",
        ids="assignedUser paymentTerms",
        reals="totalPaidAmount",
        texts="visibility substatus",
    ),
    "invoiceitem": Overrides(
        "Line of an invoice",
        skip="invoice invoiceRecurrence windowStart windowEnd",
        ids="taxGroup serviceRequest",
        reals="quantity price",
    ),
    "quote": Overrides(
        "Offer for planned work",
        skip="serviceLines jobs items tags serviceRequests",
        ids="sales terms",
        reals="taxAmount totalPrice",
        texts="deficiencyJobs visibility substatus sectionVisibilities",
        names={"taskingDetailLevel": "tasking_detail_level"},
        literal="subtotal",
    ),
    "quoteitem": Overrides(
        "Line of a quote", skip="quote", ids="serviceRequest", reals="quantity price cost taxRate"
    ),
    "asset": Overrides(
        "Equipment at a location",
        skip="taskList",
        integers="legacyId orderIndex",
        texts="properties",
        names={"isAbstractGroup": "is_abstract_group", "hasActiveTaskList": "has_active_task_list"},
        literal="display",
    ),
    "deficiency": Overrides(
        "Finding on equipment",
        ids="owner sales serviceLine",
        names={"proposedFix": "proposed_fix", "lastReportedStatus": "last_reported_status"},
    ),
    "servicerecurrence": Overrides(
        "Recurring service",
        skip="preferredTechs items taskingDuration tasks taskLists",
        ids="parent contract preferredVendor",
        integers="currentServiceRecurrence",
        texts="frequencyCategory",
        times="currently_due",
        names={
            "repeatWeekday": "repeat_weekday",
            "preferredStartTime": "preferred_start_time",
            "currentServiceRecurrence": "current_service_recurrence_id",
        },
        literal="duration interval",
    ),
    "servicerecurrenceitem": Overrides("Line of a recurring service", skip_feed=True),
    "servicerequest": Overrides(
        "Work to be done on a job",
        skip="items preferredTechs quoteRequests taskInstances taskLists",
        ids="changeOrder budget preferredVendor",
        integers="quoteLinkAttachmentVisibility quoteLinkCommentVisibility",
        texts="visibility serviceLinkAttachmentCategoryVisibility",
        times="originalWindowStart originalWindowEnd closedOn",
        names={"preferredStartTime": "preferred_start_time"},
        literal="description duration",
    ),
    "servicerequestitem": Overrides("Line of a service request", skip_feed=True),
    "user": Overrides(
        "Technician or office user",
        skip="avatar account serviceLines roles",
        ids="manager",
        integers="mfaRequired",
        texts="activities",
    ),
    "region": Overrides("Territories"),
    "tag": Overrides("Labels"),
    "taxrate": Overrides("Tax rates"),
    "paymentterms": Overrides("Payment terms"),
}


@dataclass(frozen=True)
class Profile:
    """Observed shape of a field: type name and keys of the first object in it."""

    type: str = "unknown"
    keys: tuple[str, ...] = ()


def field_plan(name: str, profile: Profile, feed: str, feeds: Mapping[str, Overrides] = FEEDS) -> Field | None:
    """One field's plan; None for the key and for fields dropped everywhere.

    Strongest first: the feed's override, common renames, timestamps, corrected
    types, address, object ids, arrays of objects, flags, texts, snake_case.
    """
    if name == "id" or name in DROPPED_EVERYWHERE:
        return None
    feed_rules = feeds.get(feed, Overrides())
    plan = feed_rules.fields().get(name, Field(name))
    if plan.skip or name in SKIPPED_EVERYWHERE:
        return Field(name, skip=True)
    if plan.key:
        return plan
    offers = []
    if name in COMMON_NAMES:
        offers.append(COMMON_NAMES[name])
    if name in TIMESTAMP_FIELDS:
        offers.append((None, "timestamp"))
    if name in CORRECTED_TYPES:
        offers.append((None, CORRECTED_TYPES[name]))
    for column, kind in offers:
        plan = replace(plan, column=plan.column or column, type=plan.type or kind)
    if name == "address" and profile.type == "object":
        return replace(plan, spread=ADDRESS_COLUMNS)
    if profile.type == "object" and "id" in profile.keys and name not in feed_rules.literal.split():
        snake = snake_name(name)
        fallback = snake if snake.endswith("_id") else f"{snake}_id"
        return replace(plan, key="id", type="integer", column=plan.column or fallback)
    if profile.type == "array" and profile.keys:
        return Field(name, skip=True)
    if profile.type == "boolean":
        return replace(plan, type=plan.type or "integer", column=plan.column or FLAG_NAMES.get(name))
    if profile.type in ("array", "object"):
        return replace(plan, type=plan.type or "text")
    return plan


def resource_plan(profiles: Mapping[str, Profile], feed: str, feeds: Mapping[str, Overrides] = FEEDS) -> list[Field]:
    """Plans of all observed fields, then of fields only the rules know about."""
    plans = [p for n, profile in profiles.items() if (p := field_plan(n, profile, feed, feeds))]
    known = feeds.get(feed, Overrides()).fields()
    extra = [Field(n, skip=True) if f.skip else f for n, f in known.items() if n not in profiles]
    return plans + extra


def planned_feeds(feeds: Mapping[str, Overrides] = FEEDS) -> list[str]:
    return [name for name, rules in feeds.items() if not rules.skip_feed]
