"""A seeded set of people seen by four systems, with known truth."""

import json
import random

GIVEN = "Ada Ben Cleo Dora Emil Fay Gus Hana Ivo Jill Kurt Lena Milo Nora Otto Pia Quin Rosa Sven Tara".split()
FAMILY = "Abel Brandt Costa Dunn Ebert Fox Graf Horn Ilic Jung Koch Lang Moss Noor Opitz Park Roth Stein Toth Vogel".split()


def people(count=200, seed=7):
    """(raw rows per source, truth rows). Every person is in one to four sources."""
    rng = random.Random(seed)
    raw = {"erp": [], "crm": [], "flatfile": [], "partner_api": []}
    truth = []
    for i in range(count):
        given, family = rng.choice(GIVEN), rng.choice(FAMILY)
        base = {
            "name": f"{given} {family}",
            "email": f"{given}.{family}{i}@mail.example".lower(),
            "tax": f"TAX-{10000 + i}",
            "address": f"{rng.randrange(1, 999)} Main St",
            "country": rng.choice(["US", "CA", "UK", "IN", "DE"]),
            "zip": f"{rng.randrange(0, 99999):05d}",
        }
        for source in rng.sample(list(raw), rng.randint(1, 4)):
            name = base["name"]
            if rng.random() < 0.4:
                name = rng.choice([f"{given[0]}. {family}", f"{given} {family[0]}.", name.upper(), name.lower(), f"{given}  {family}"])
            raw_id = f"{i:05d}"
            raw[source].append(
                {
                    "customer_id": raw_id,
                    "full_name": None if rng.random() < 0.03 else name,
                    "email": base["email"] if rng.random() > 0.1 else "not-an-email",
                    "tax_id": base["tax"] if rng.random() > 0.1 else "???",
                    "address_line1": base["address"],
                    "country_code": base["country"],
                    "postal_code": base["zip"],
                    "updated_at": f"2026-{rng.randint(1, 7):02d}-{rng.randint(10, 28):02d}",
                }
            )
            truth.append((f"{source}:{raw_id}", f"P{i:05d}"))
    return raw, truth


def write(root, entity, raw, part=""):
    """One landing file per source, in the raw column names and format of that source."""
    import pandas as pd

    for source in entity.sources:
        rows = [{source.columns[c]: v for c, v in r.items()} for r in raw[source.name]]
        folder = root / source.landing_path
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"customers{part}.{source.format}"
        if source.format == "json":
            path.write_text(json.dumps(rows))
        elif source.format == "csv":
            pd.DataFrame(rows).to_csv(path, index=False)
        else:
            pd.DataFrame(rows).to_parquet(path, index=False)
