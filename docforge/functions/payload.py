"""Model payloads: strict JSON objects in either of two shapes, as one shape of fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.functions.text import clamp, let

FIELD = "struct<value:string,confidence:double,evidence_text:string,reasoning_brief:string,source_method:string>"


def strip_fence(c: Column) -> Column:
    """Without a Markdown fence, if the text starts with one."""
    inner = lambda t: F.regexp_replace(F.regexp_replace(t, r"^```(?:json)?\s*", ""), r"\s*```$", "")
    return let(F.btrim(c, F.lit(" \n\t\r")), lambda t: F.when(F.startswith(t, F.lit("```")), F.btrim(inner(t), F.lit(" \n\t\r"))).otherwise(t))


def parse_object(c: Column) -> Column:
    """(ok, payload as VARIANT, error): an error unless the text is a JSON object."""

    def parsed(value: Column, ok: Column) -> Column:
        error = F.when(value.isNull(), "invalid JSON").when(~ok, "not a JSON object")
        return F.struct(ok.alias("ok"), F.when(ok, value).alias("payload"), error.alias("error"))

    return let(F.try_parse_json(strip_fence(c)), lambda value: let(members(value).isNotNull(), lambda ok: parsed(value, ok)))


def get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def scalar(v: Column) -> Column:
    """Trimmed text of a scalar; containers and empty texts are null.

    The value and its text are made once; its kind is only asked for where the text could be a container's.
    """

    def plain(v: Column, text: Column) -> Column:
        held = F.substring(text, 1, 1).isin("{", "[") & F.substring(F.schema_of_variant(v), 1, 3).isin("OBJ", "ARR")
        return F.when(text != "", F.when(~held, text))

    return let(v, lambda v: F.when(v.isNotNull(), let(F.trim(F.try_variant_get(v, "$", "string")), lambda text: plain(v, text))))


def members(v: Column) -> Column:
    """An object's members as a map, cast once for all the keys that are asked; null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def first_present(known: Column, *keys: str) -> Column:
    """The value of the first key that a map of members has, even if it is null: a JSON null is a VARIANT, no null."""
    return F.coalesce(*(F.try_element_at(known, F.lit(k)) for k in keys))


def field(value: Column, confidence: Column, evidence: Column, reasoning: Column, method: str) -> Column:
    """A field from an object with value, confidence, evidence_text and reasoning_brief, or from a scalar."""

    def made(text: Column, sure: Column, proof: Column, reason: Column) -> Column:
        return F.struct(text.alias("value"), sure.alias("confidence"), proof.alias("evidence_text"), reason.alias("reasoning_brief"), F.lit(method).alias("source_method"))

    def nested(m: Column) -> Column:
        own = lambda k: scalar(F.try_element_at(m, F.lit(k)))
        sure = F.try_variant_get(F.try_element_at(m, F.lit("confidence")), "$", "string")
        return made(own("value"), F.coalesce(clamp(sure, float("nan")), confidence), F.coalesce(own("evidence_text"), evidence), F.coalesce(own("reasoning_brief"), reasoning))

    def plain(v: Column) -> Column:
        return let(scalar(v), lambda text: made(text, F.when(text.isNotNull(), confidence).otherwise(0.0), evidence, reasoning))

    absent = made(F.lit(None).cast("string"), F.lit(0.0), evidence, reasoning)
    present = lambda v: let(members(v), lambda m: F.when(m.isNotNull(), nested(m)).otherwise(plain(v)))
    return let(value, lambda v: F.when(v.isNull(), absent).otherwise(present(v)))


def extractor_output(payload: Column, method: str) -> Column:
    """(method, case_fields, participants, warnings) of a payload with public or internal keys.

    Confidences come from the document's map for parties too. The reasoning summary is added to the warnings. The payload
    and each object in it are taken apart once; only the fields of the shape that it has are made.
    """
    none = F.lit(None).cast("string")

    def output(top: Column, sure: Column, proofs: Column) -> Column:
        conf = lambda *keys: clamp(scalar(first_present(sure, *keys)))
        proof = lambda known, *keys: scalar(first_present(known, *keys))
        at = lambda known, key: F.try_element_at(known, F.lit(key))
        items = lambda key: F.coalesce(F.try_variant_get(at(top, key), "$", "array<variant>"), F.array().cast("array<variant>"))
        summary = scalar(at(top, "reasoning_summary"))
        internal = F.coalesce(F.map_contains_key(top, "case_info"), F.lit(False))

        def inside() -> Column:
            case = let(members(at(top, "case_info")), lambda info: F.struct(*(field(at(info, own), conf(own), none, none, method).alias(own) for own in V.PUBLIC_CASE_KEYS.values())))
            party = lambda known: F.struct(*(field(at(known, own), conf(own), none, none, method).alias(own) for own in V.PUBLIC_PARTY_KEYS.values()))
            return F.struct(case.alias("case_fields"), F.transform(F.transform(items("participants"), members), party).alias("participants"))

        def outside() -> Column:
            reason = lambda public: summary if public == "legal_relationship" else none
            case = F.struct(*(field(at(top, public), conf(public, own), proof(proofs, public, own), reason(public), method).alias(own) for public, own in V.PUBLIC_CASE_KEYS.items()))

            def party(known: Column) -> Column:
                own_proofs = members(at(known, "evidence_by_field"))
                return let(own_proofs, lambda p: F.struct(*(field(at(known, public), conf(public, own), proof(p, public, own), none, method).alias(own) for public, own in V.PUBLIC_PARTY_KEYS.items())))

            people = F.filter(F.transform(items("parties"), members), lambda m: m.isNotNull())
            return F.struct(case.alias("case_fields"), F.transform(people, party).alias("participants"))

        notes = F.filter(F.transform(items("warnings"), lambda w: F.trim(F.try_variant_get(w, "$", "string"))), lambda w: w != "")
        more = F.filter(F.array(summary), lambda x: x.isNotNull())
        parts = F.when(internal, inside()).otherwise(outside())
        return let(parts, lambda p: F.struct(F.lit(method).alias("method"), p["case_fields"].alias("case_fields"), p["participants"].alias("participants"), F.concat(notes, more).alias("warnings")))

    own = lambda top, key: members(F.try_element_at(top, F.lit(key)))
    return let(members(payload), lambda top: let(own(top, "confidence_by_field"), lambda sure: let(own(top, "evidence_by_field"), lambda proofs: output(top, sure, proofs))))


def rule_output(case: Column, people: Column, method: str) -> Column:
    """The same shape from the rules' case and parties: confidence 0.45, the value as its own evidence."""

    def own(value: Column) -> Column:
        return F.struct(value.alias("value"), F.when(value.isNotNull(), V.RULE_CONFIDENCE).otherwise(0.0).alias("confidence"), value.alias("evidence_text"), F.lit(None).cast("string").alias("reasoning_brief"), F.lit(method).alias("source_method"))

    fields = F.struct(*(own(case[k]).alias(k) for k in V.CASE_FIELDS))
    parties = F.transform(people, lambda p: F.struct(*(own(p[k]).alias(k) for k in V.PARTY_FIELDS)))
    return F.struct(F.lit(method).alias("method"), fields.alias("case_fields"), parties.alias("participants"), F.array().cast("array<string>").alias("warnings"))
